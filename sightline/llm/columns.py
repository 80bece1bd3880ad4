"""Helper columns beside a user's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have; names that differ in case only count as equal."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def document_key() -> Column:
    """What tells a document row from others but its copies: id, whether it has one, and the hash of its text."""
    key = F.col("doc_id").cast("long")
    return F.struct(F.coalesce(key, F.lit(0)).alias("id"), key.isNull().alias("none"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))


def key_of(doc_id: str, h: str) -> Column:
    """The same from an id and a hash at hand."""
    return F.struct(F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"), F.col(doc_id).isNull().alias("none"), F.col(h).alias("h"))
