"""Citations of labelled rows in published text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave import schemas as S

CITED = r"(?U)\bE\d{2}\b"


def cited_ids(texts: DataFrame, index: DataFrame, text_id: str = "doc_id") -> DataFrame:
    """Distinct row ids that each text cites and the index knows."""
    tokens = texts.select(
        text_id, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(CITED), F.lit(0)))).alias("id")
    )
    return tokens.join(index.select("id").distinct(), "id", "left_semi")


def citation_lint(texts: DataFrame, index: DataFrame, text_id: str = "doc_id") -> DataFrame:
    """Each cited row with its label, whether the label is allowed, and the message."""
    labels = index.select("id", F.coalesce("label", F.lit("<missing>")).alias("label"))
    shown = F.concat(F.col("id"), F.lit(" ("), F.col("label"), F.lit(")"))
    allowed = F.col("label").isin(*S.ALLOWED_LABELS)
    failing = F.concat(shown, F.lit(" — must be " + "/".join(S.ALLOWED_LABELS)))
    return (
        cited_ids(texts, index, text_id)
        .join(labels, "id")
        .select(
            text_id, "id", "label", allowed.alias("passes"), F.when(allowed, shown).otherwise(failing).alias("message")
        )
    )
