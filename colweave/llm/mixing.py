"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the bytes over the share it has; each document repeats
Poisson(rate) times, found by inverting the distribution at a number in [0, 1) that is hashed from
seed and doc_id. A rate above `MEAN` is drawn as the sum of independent parts of equal mean, each at
most `MEAN` and at a number of its own, which is a Poisson draw of the whole rate; so the table of a
source stays below `MEAN` + 10 sqrt(`MEAN`) + 22 numbers, however small the source is. Copies are then
put in one global random order by hash. All of it is columns and joins: the distribution of each source
is a small table of cumulative probabilities, written once so that the planner knows its size, and
joined on the source. Copies are numbered by `int`, so a document with 2^31 copies or more is an error.

Edge cases: a null source is a source of its own; a source without target weight (when weights are
given) has rate 0; a source whose texts are all empty has rate 1, as nothing can be weighed; rows
with equal ids draw equal counts; a null id draws as empty text; an empty table gives an empty one;
extra columns are kept, even if named like the operator's own working columns (`mix` returns its own
`mix_copy` and `mix_order`, `repeat` those of the documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colweave.llm import tables as B
from colweave.session import cut_lineage

SEED = 42
#: Largest mean of one draw, and copies of a document that one array numbers.
MEAN = 64
RANGE = 4096


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 random bits, hashed from the parts."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _id(key: str = "doc_id") -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Mean repetitions of each source (mix_source, mix_rate); without weights all count alike."""
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("bytes"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for source, share in weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(source)), F.lit(float(share))).otherwise(weight)
    sizes = cut_lineage(sizes.select("mix_source", "bytes", weight.alias("weight")))
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(float(total["bytes"] or 0)) / F.col("bytes")
    return sizes.select("mix_source", F.when(F.col("bytes") == 0, 1.0).when(F.col("weight") <= 0, 0.0).otherwise(rate).alias("mix_rate"))


def distributions(rate: DataFrame) -> DataFrame:
    """How many parts each source is drawn in, and the Poisson distribution function of a part as an
    array, far enough that what is left is below 1e-16."""
    rate = rate.where("mix_rate > 0").withColumn("mix_parts", F.ceil(F.col("mix_rate") / MEAN))
    rate = rate.withColumn("mix_rate", F.col("mix_rate") / F.col("mix_parts"))
    k = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("mix_rate") + 10 * F.sqrt("mix_rate")) + 20).cast("int"))).alias("k")
    up = Window.partitionBy("mix_source").orderBy("k")
    log = F.col("k") * F.log("mix_rate") - F.col("mix_rate") - F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(up)
    points = rate.select("mix_source", "mix_parts", "mix_rate", k).select("mix_source", "mix_parts", "k", F.exp(log).alias("p"))
    sums = points.select("mix_source", "mix_parts", "k", F.sum("p").over(up).alias("cdf"))
    return sums.groupBy("mix_source", "mix_parts").agg(F.sort_array(F.collect_list("cdf")).alias("mix_cdf"))


def _repeated(docs: DataFrame, weights: dict[str | None, float] | None, seed: int) -> DataFrame:
    """Each document as often as drawn, in global random order, its columns named by position (c0,
    c1 ...), with `mix_copy` and `mix_order`."""
    table = cut_lineage(distributions(rates(docs, weights)))
    places = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = list(places.values())
    drawn = docs.toDF(*own).join(table, F.col(places["source"]).eqNullSafe(F.col("mix_source")))
    u = lambda part: uniform(str(seed), _id(places["doc_id"]), F.when(part > 1, part.cast("string")))
    draw = lambda part: F.size(F.filter("mix_cdf", lambda c: c <= u(part)))
    total = F.aggregate(F.sequence(F.lit(1), F.col("mix_parts").cast("int")), F.lit(0), lambda n, part: n + draw(part))
    copies = drawn.withColumn("mix_copies", total).where("mix_copies > 0")
    # in ranges, so that no array grows with the rate
    copies = copies.withColumn("mix_from", F.explode(F.sequence(F.lit(1), F.col("mix_copies"), F.lit(RANGE))))
    last = F.least(F.col("mix_copies"), F.col("mix_from") + F.lit(RANGE - 1))
    copies = copies.withColumn("mix_copy", F.explode(F.sequence(F.col("mix_from"), last)))
    copies = copies.withColumn("mix_order", F.md5(F.concat_ws("|", F.lit(f"{seed} order"), _id(places["doc_id"]), F.col("mix_copy"))))
    return copies.orderBy("mix_order").select(*own, "mix_copy", "mix_order")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """Each document as often as drawn, in global random order, with `mix_copy` from 1. These two
    columns take the place of columns of the same name."""
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in ("mix_copy", "mix_order")]
    return _repeated(docs, weights, seed).select(*kept, "mix_copy", "mix_order")


def repeat(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """As `mix`, with the columns of docs and no other, whatever their names."""
    return _repeated(docs, weights, seed).select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "mix_copy", "mix_order", "text")


MIX_SQL = f"""
WITH sizes AS (
  SELECT source, sum(strlen(coalesce(text, ''))) AS bytes, 1.0::DOUBLE AS weight FROM documents GROUP BY source),
total AS (SELECT sum(bytes)::DOUBLE AS all_bytes, sum(weight) AS all_weight FROM sizes),
rates AS (
  SELECT source, CASE WHEN bytes = 0 THEN 1.0::DOUBLE ELSE weight / all_weight * all_bytes / bytes END AS rate FROM sizes, total),
parted AS (SELECT source, rate / ceil(rate / {MEAN}) AS rate, ceil(rate / {MEAN})::BIGINT AS parts FROM rates WHERE rate > 0),
points AS (
  SELECT source, rate, unnest(range(0, (ceil(rate + 10 * sqrt(rate)) + 21)::BIGINT)) AS k FROM parted),
logs AS (
  SELECT source, k, exp(k * ln(rate) - rate - sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k)) AS p FROM points),
cdf AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM logs),
numbered AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
parts AS (
  SELECT r, doc_id, n.source, unnest(range(1, parts + 1)) AS part FROM numbered n JOIN parted p ON p.source IS NOT DISTINCT FROM n.source),
drawn AS (
  SELECT r, source, ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || CASE WHEN part > 1 THEN '|' || part ELSE '' END), 1, 13))::BIGINT::DOUBLE
    / 4503599627370496.0 AS u FROM parts),
counted AS (
  SELECT r, sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u))::BIGINT AS copies FROM drawn d GROUP BY r),
copied AS (SELECT doc_id, source, text, unnest(range(1, copies + 1))::INT AS mix_copy FROM numbered JOIN counted USING (r))
SELECT doc_id, source, mix_copy, md5('{SEED} order|' || coalesce(doc_id::VARCHAR, '') || '|' || mix_copy) AS mix_order, text FROM copied
"""
