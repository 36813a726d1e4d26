"""URL filter by fixed rules and by association rules mined from labels.

A basket is a URL's tokens (scheme, labels of the host and their parts, path segments that are
words, query keys) and, for a labelled page, whether it is bad (quality 0 or toxic). Spark's
FP-growth mines the frequent combinations; rules "tokens => bad" that pass support and confidence
block a page that has all their tokens. Tokens that stand on the same labelled pages are mined as one
(any of them makes it), so a long URL in several copies adds one item and not all subsets of its
words; the rules then block exactly what those of all subsets would. Rules are matched by an inverted
index: each stands under its rarest token only, so a page meets few rules, and then must contain the rest.

Fixed host and path rules come first, the longest that fits wins. Edge cases: a null URL or one
without "://" has empty host and path, no tokens, and is allowed; repeated URLs are judged alike;
labels that are null in both columns are ignored; without a bad page no rule is mined;
extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colweave.llm import tables as B
from colweave.session import cut_lineage

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: Least share of labelled pages with all tokens of a rule, least number of them, and least share
#: of bad pages among them.
MIN_SUPPORT = 0.002
MIN_PAGES = 8
MIN_CONFIDENCE = 0.6
BAD = "=bad"


class Mined(NamedTuple):
    """Rules (rule_tokens, confidence, pages) and, for each name in them, the tokens it stands for (token, name)."""

    rules: DataFrame
    names: DataFrame


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(h: Column, p: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, word in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = text.partition("/")
        fits = ((h == at) | h.endswith("." + at)) & p.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL, each marked by the part it is from."""
    h = host(url)
    tag = lambda mark, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    labels = F.split(h, r"\.")
    words = F.filter(F.split(F.lower(path(url)), "/"), lambda x: x.rlike("^[^0-9]+$"))
    keys = F.transform(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&"), lambda x: F.substring_index(x, "=", 1))
    scheme = F.array(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z]+)://", 1)))
    found = F.concat(tag("scheme:", scheme), tag("host:", labels), tag("word:", F.split(h, r"[.\-_]")), tag("path:", words), tag("key:", keys))
    return F.when(h != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def same_pages(entries: DataFrame, least: int) -> DataFrame:
    """Tokens that at least ``least`` baskets have, and the name (the smallest token) of those that stand
    in exactly the same baskets: (token, name).

    Sums of hashes propose who may be the same; then every basket that has one of a group must have
    as many as the group holds, or the group stays apart.
    """
    mark = lambda k: F.sum(F.pmod(F.xxhash64("basket", F.lit(k)), F.lit(1 << 31)))
    prints = cut_lineage(entries.groupBy("token").agg(F.count("*").alias("n"), mark(1).alias("one"), mark(2).alias("two")).where(F.col("n") >= least))
    key = ["n", "one", "two"]
    groups = prints.groupBy(*key).agg(F.min("token").alias("name"), F.count("*").alias("members"))
    named = cut_lineage(prints.join(groups, key).select("token", "name", "members"))
    shared = named.where("members > 1")
    met = entries.join(shared, "token").groupBy("basket", "name", "members").agg(F.count("*").alias("have"))
    apart = met.where("have < members").select("name").distinct().withColumn("apart", F.lit(True))
    return cut_lineage(named.join(apart, "name", "left").select("token", F.when(F.col("apart"), F.col("token")).otherwise(F.col("name")).alias("name")))


def mine(pages: DataFrame, labels: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> Mined:
    """Rules "names => bad" from the labelled pages."""
    marked = labels.where("coalesce(quality, toxic) is not null").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    known = pages.select(F.col("page_id").alias("doc_id"), tokens(F.col("url")).alias("found")).where("size(found) > 0").join(marked, "doc_id")
    # numbered once, in the written table
    baskets = cut_lineage(known.select(F.monotonically_increasing_id().alias("basket"), F.col("bad").eqNullSafe(1).alias("bad"), "found"))
    n = baskets.count()
    least = max(MIN_PAGES, math.ceil(support * n - 1e-9))
    entries = baskets.select("basket", "bad", F.explode("found").alias("token"))
    names = same_pages(entries, least)
    items = entries.join(names, "token").groupBy("basket").agg(F.collect_set("name").alias("items"), F.max("bad").alias("bad"))
    items = cut_lineage(items.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items")))
    m = items.count()
    if not m:
        return Mined(baskets.sparkSession.createDataFrame([], "rule_tokens array<string>, confidence double, pages long"), names)
    # (least - 0.5) / m: the least number of baskets, whatever the rounding
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / m), minConfidence=confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0] == BAD)
    rules = rules.select(F.col("antecedent").alias("rule_tokens"), "confidence", F.round(F.col("support") * m).cast("long").alias("pages"))
    return Mined(cut_lineage(rules), names)


def matches(urls: DataFrame, mined: Mined) -> DataFrame:
    """URLs that a mined rule blocks, with the surest rule."""
    rules = mined.rules
    wanted = mined.names.join(rules.select(F.explode("rule_tokens").alias("name")).distinct(), "name", "left_semi")
    having = urls.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(wanted, "token").groupBy("url").agg(F.collect_set("name").alias("found"))
    having = cut_lineage(having)
    counts = having.select(F.explode("found").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    one = rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("name")).join(counts, "name")
    index = one.groupBy("rule_tokens").agg(F.min(F.struct("n", "name"))["name"].alias("name"), F.max("confidence").alias("confidence"))
    met = having.select("url", "found", F.explode("found").alias("name")).join(index, "name")
    met = met.where(F.size(F.array_except("rule_tokens", "found")) == 0)
    return met.groupBy("url").agg(F.max(F.struct("confidence", F.array_join(F.sort_array("rule_tokens"), " ").alias("mined_rule"))).alias("best")).select("url", "best.*")


def judge(pages: DataFrame, mined: Mined) -> DataFrame:
    """Host, path, fixed rule and verdict of every page; the mined rules decide where no fixed one fits."""
    h, p = host(F.col("url")), path(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    pages = pages.select("page_id", "url", h.alias("host"), p.alias("path")).select("*", rule.alias("rule"), verdict.alias("fixed"))
    open_urls = pages.where("rule is null and host != ''").select("url").distinct()
    found = matches(open_urls, mined)
    out = pages.join(found, "url", "left")
    by_mining = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("fixed", by_mining).alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, mine(pages, B.read(spark, sf_dir, "labels")))
