"""Table operators with the ordering and NULL rules the pipeline relies on.

Ordering follows the database convention: ascending puts NULLs last, descending
puts them first. State tables are never changed in place: each operator maps an
old table and its changes to a new table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def first_per_group(df: DataFrame, keys: Sequence[str], order: dict[str, str]) -> DataFrame:
    """First row of each group by ``order``, a column name to "asc" or "desc".

    All other columns break ties ascending, so the choice is always fixed.

    The rank filter lets Catalyst keep one row per key and task *before* the
    shuffle, so a key with a third of all rows costs one row per task.
    """
    ranked = [desc(n) if way == "desc" else asc(n) for n, way in order.items()]
    ties = [asc(n) for n in df.columns if n not in keys and n not in order]
    # without any other column all rows of a group are equal
    w = Window.partitionBy(*keys).orderBy(*(ranked + ties or [asc(keys[0])]))
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Set columns of matching target rows from a source with one row per key.

    ``values`` maps a target column to the source column it takes. Rows without
    a match keep what they have (NULL for a column the target does not have yet).
    """
    src = source.select(
        *[F.col(k).alias(f"_k_{k}") for k in on],
        *[F.col(s).alias(f"_v_{t}") for t, s in values.items()],
        F.lit(True).alias("_hit"),
    )
    joined = target.join(src, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in on]), "left")
    kept = []
    for name in target.columns:
        if name in values:
            kept.append(F.when(F.col("_hit"), F.col(f"_v_{name}")).otherwise(F.col(name)).alias(name))
        else:
            kept.append(F.col(name))
    added = [F.col(f"_v_{n}").alias(n) for n in values if n not in target.columns]
    return joined.select(*kept, *added)


def is_in(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    return df.join(listed.select(column), column, "left_semi").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: dict[str, str]) -> DataFrame:
    """``first_per_group`` as an aggregation; columns in descending order must be numbers.

    Every task reduces its rows to one per key before the shuffle, and Catalyst can
    push a filter on the keys, also a join with a short list of them, below it.
    """
    rank = []
    for name, way in order.items():
        rank += [F.col(name).isNotNull(), -F.col(name)] if way == "desc" else [F.col(name).isNull(), F.col(name)]
    others = [n for n in df.columns if n not in keys]
    for name in others:
        rank += [F.col(name).isNull(), F.col(name)] if name not in order else []
    if not others:
        return df.select(*keys).distinct()
    if len(others) == 1 and others == list(order):  # one column: its extreme is a plain maximum or minimum, which needs no sort
        (name, way), = order.items()
        extreme = F.when(F.count_if(F.col(name).isNull()) == 0, F.max(name)) if way == "desc" else F.min(name)
        return df.groupBy(*keys).agg(extreme.alias(name)).select(*df.columns)
    first = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(rank)])
    # plain aggregates: a projection above them would keep a join with the keys from going below
    return df.groupBy(*keys).agg(*[F.min_by(n, first).alias(n) for n in others]).select(*df.columns)


def per_listed_key(
    df: DataFrame, listed: DataFrame, column: str, reduce_groups: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``reduce_groups(df)`` for the listed keys only; it must group by ``column``, alone or among others.

    Groups are reduced first and then joined with the list, so a key with a third of
    all rows is a row per task before anything is shuffled, however long the list. A
    list that Spark broadcasts by its size is pushed by Catalyst below an aggregation
    (``first_per_key``, ``groupBy``), down to the scan; above that size its runtime
    Bloom filter can go there.
    """
    return is_in(reduce_groups(df), listed, column)


def exclude(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """Delete the rows whose key is listed. A NULL key is never deleted."""
    return df.join(listed.select(column), column, "left_anti").select(*df.columns)


def not_in(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """``NOT IN`` with its NULL rule: one NULL in the list and no row passes.

    A literal ``NOT IN`` is planned with the whole list broadcast whatever its
    size. Here the two counts are one-row subqueries and the rest is an ordinary
    anti join, which can shuffle.
    """
    total = listed.agg(F.count(F.lit(1))).scalar()
    nulls = listed.agg(F.count_if(F.col(column).isNull())).scalar()
    passed = df.filter((total == 0) | ((nulls == 0) & F.col(column).isNotNull()))
    return exclude(passed, listed, column)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (unknown stays)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def upsert(old: DataFrame, new: DataFrame, key: str, set_columns: Sequence[str]) -> DataFrame:
    """Update rows of ``old`` by key, then add the keys it does not have.

    Columns outside ``set_columns`` keep their old value. Several new rows per
    key: the first by value updates an old row, all are added to a new key.
    """
    one = first_per_group(new.select(key, *set_columns), [key], {})
    updated = update_from(old, one, [key], {n: n for n in set_columns})
    added = exclude(new, old, key)
    return updated.unionByName(added.select(*[
        F.col(n) if n in added.columns else F.lit(None).cast(old.schema[n].dataType).alias(n) for n in old.columns
    ]))


def drop_by_key(old: DataFrame, listed: DataFrame, key: str, scope: Column) -> DataFrame:
    """Rows without those in ``scope`` whose key is listed.

    Rows outside the scope do not take part in the join.
    """
    inside = F.coalesce(scope, F.lit(False))
    return old.filter(~inside).unionByName(exclude(old.filter(inside), listed, key))


def replace_by_key(old: DataFrame, listed: DataFrame, key: str, scope: Column, new: DataFrame) -> DataFrame:
    """Drop the listed keys within the scope, then append ``new``."""
    return drop_by_key(old, listed, key, scope).select(*old.columns).unionByName(new.select(*old.columns))


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition holds, the others)."""
    return df.filter(condition), delete_where(df, condition)
