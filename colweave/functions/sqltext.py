"""Rules on SQL text: normalising, cache keys, masking literals, dynamic-SQL markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S

# Every Unicode white-space character plus the four ASCII separators, spelled out so that all
# regular-expression dialects agree on it.
WHITESPACE = (
    r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)

# What counts as quoted identifier, string literal and number.
QUOTED = r"(`[^`]*`|\"[^\"]*\"|\[[^\]]*\])"
STRING = r"'(?:''|\\'|[^'])*'"
NUMBER = r"\b\d+(?:\.\d+)?(?:[eE][+-]?\d+)?\b"
MASK = "'<REDACTED>'"

# Possessive form of STRING: it never backtracks, so a long literal cannot exhaust the JVM
# stack. It finds the same literals as long as each one is closed.
CLOSED_STRING = r"'(?:''|\\'|[^'\\]|\\)*+'"
# The longest start of a text in which every literal is closed, and what STRING finds after it:
# from the open quote to the last quote that no other quote can extend.
CLOSED_HEAD = r"^(?:[^']|'(?:''|\\'|[^'\\]|\\)*+')*+"
OPEN_STRING = r"'[\s\S]*(?:'(?='[^']*\z)|(?<=\\)'(?=[^']*\z))"


def normalize_sql(sql: Column) -> Column:
    return F.trim(F.regexp_replace(sql, WHITESPACE, " "))


def cache_key(sql: Column, dialect: Column, mode: Column, parser_version: Column, tool_version: Column) -> Column:
    parts = [normalize_sql(sql), dialect, mode, parser_version, tool_version]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def mask_literals(df: DataFrame, sql: str = "sql", out: str = "masked") -> DataFrame:
    """Add ``out``: ``sql`` with strings and numbers masked and quoted identifiers kept.

    Identifiers are cut out first, over the whole text, and put back last. What stands before the
    first quote that is never closed has closed literals only; from there on, the text up to the
    last quote that can end a literal is one literal. All of it runs in the JVM, by patterns that
    do not recurse, so literals may be of any length.
    """
    mark, end, nul = F.lit("\u0000q"), F.lit("\u0000"), F.lit("\u0000!")
    placeholder = "\\x00q([0-9]+)\\x00"
    text = F.replace(F.col(sql), F.lit("\u0000"), nul)
    # every gap but the last is followed by the placeholder of its identifier
    stashed = F.array_join(
        F.transform(
            F.split(F.col("_text"), QUOTED, -1),
            lambda gap, i: F.when(i < F.size("_ids"), F.concat(gap, mark, i.cast("string"), end)).otherwise(gap),
        ),
        "",
    )
    head = F.regexp_extract("_stashed", CLOSED_HEAD, 0)
    rest = F.substring(F.col("_stashed"), F.length("_head") + 1, F.length("_stashed"))
    masked = F.concat(F.regexp_replace("_head", CLOSED_STRING, MASK), F.regexp_replace(rest, OPEN_STRING, MASK))
    # an identifier inside a literal is masked with it, so the survivors name themselves
    survivors = F.regexp_extract_all(F.col("_numbers"), F.lit(placeholder), F.lit(1))
    restored = F.array_join(
        F.transform(
            F.split("_numbers", placeholder, -1),
            lambda piece, i: F.concat(piece, F.coalesce(F.get(F.col("_ids"), F.get(F.col("_left"), i).cast("int")), F.lit(""))),
        ),
        "",
    )
    steps = (
        df.withColumn("_text", text)
        .withColumn("_ids", F.regexp_extract_all(F.col("_text"), F.lit(QUOTED), F.lit(0)))
        .withColumn("_stashed", stashed)
        .withColumn("_head", head)
        .withColumn("_numbers", F.regexp_replace(masked, "(?U)" + NUMBER, "0"))
        .withColumn("_left", survivors)
    )
    return steps.withColumn(out, F.replace(restored, nul, F.lit("\u0000"))).drop("_text", "_ids", "_stashed", "_head", "_numbers", "_left")


def _first_marker(sql: Column, values: list) -> Column:
    upper = F.upper(F.coalesce(sql, F.lit("")))
    out = F.lit(None)
    for (text, _), value in reversed(list(zip(S.DYNAMIC_MARKERS, values))):
        out = F.when(upper.contains(text), value).otherwise(out)
    return out


def dynamic_sql_marker(sql: Column) -> Column:
    return _first_marker(sql, [F.lit(name) for _, name in S.DYNAMIC_MARKERS])


def marker_excerpt(sql: Column, around: int = 40) -> Column:
    """The marker with up to ``around`` characters on each side; null without a marker."""
    cuts = []
    for text, _ in S.DYNAMIC_MARKERS:
        at = F.instr(F.upper(sql), text)
        start = F.greatest(at - around, F.lit(1))
        cuts.append(F.substring(sql, start, at + len(text) + around - start))
    return _first_marker(sql, cuts)
