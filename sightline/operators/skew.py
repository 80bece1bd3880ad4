"""Joins on keys that may hold a large share of all rows.

A heavy key is dealt over a number of salts that grows with its share of the rows; the
other side brings its rows of that key once for each salt. Heavy keys are those above
the ``MOST``-th of all rows, so there are fewer than ``MOST`` of them whatever the size
of the data, and the list is small. Nothing is dropped and nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 2000
LEAST_ROWS = 100_000  # a key below that needs no salt

Salts = dict[str, list[tuple]]


def heavy_keys(df: DataFrame, columns: list[str], least_rows: int = LEAST_ROWS, most: int = MOST) -> Salts:
    """For each column its heavy keys in ``df`` with their numbers of salts; one pass, counts combine before the shuffle."""
    total = df.agg(F.count(F.lit(1))).scalar()
    unit = F.greatest(F.lit(least_rows), F.ceil(total / most))
    heavy = None
    for name in columns:
        keys = [F.col(n) if n == name else F.lit(None).cast(df.schema[n].dataType).alias(n) for n in columns]
        salts = F.ceil(F.col("count") / unit).cast("int").alias("salts")
        one = df.filter(F.col(name).isNotNull()).groupBy(name).count().select(F.lit(name).alias("column"), *keys, salts).filter("salts > 1")
        heavy = one if heavy is None else heavy.unionByName(one)
    out: Salts = {name: [] for name in columns}
    for r in heavy.collect():  # fewer than ``most`` of each column
        out[r["column"]].append((r[r["column"]], r["salts"]))
    return out


def _salts_of(df: DataFrame, column: str, heavy: list[tuple]) -> DataFrame:
    """(column, salts) of the heavy keys; a list below ``MOST`` rows, so it may be broadcast."""
    kind = df.schema[column].dataType.simpleString()
    return F.broadcast(df.sparkSession.createDataFrame(heavy, f"`{column}` {kind}, _salts int"))


def salted_join(many: DataFrame, few: DataFrame, column: str, heavy: list[tuple]) -> DataFrame:
    """``many.join(few, column)``, where the heavy keys of ``many`` are dealt over their salts by a hash of the row."""
    if not heavy:
        return many.join(few, column)
    others: list[Column] = [F.col(n) for n in many.columns if n != column]
    place = F.pmod(F.xxhash64(*others), F.coalesce("_salts", F.lit(1))).cast("int")
    dealt = many.join(_salts_of(many, column, heavy), column, "left").withColumn("_salt", place).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    repeated = few.join(_salts_of(few, column, heavy), column, "left").withColumn("_salt", copies).drop("_salts")
    return dealt.join(repeated, [column, "_salt"]).drop("_salt")
