"""Near-duplicate vectors by an inverted multi-index, verified by cosine.

1. Equal vectors are one class, so copies cost nothing further.
2. Each half of the unit vectors gets a codebook of its own, by k-means on at most
   ``SAMPLE`` classes. A pair of codewords is a cell of the product grid. Every class is
   indexed.
3. How many cells to visit is measured on the sample: from each vector, to a random
   vector just at the threshold and to its true neighbours in the sample, the place of
   the other's cell in the multi-sequence order; ``RECALL`` of these must be met, by all
   cells of the grid if need be, which is then exact.
4. Cells are put together to blocks of about ``BLOCK`` members; a larger cell is spread
   over several. A class goes to the blocks of the cells nearest to it: the multi-sequence
   order, smallest sums of the distances of both halves.
5. In each block the members stand still and the visitors stream past, in matrices of
   bounded size. What leaves a block is a number of links for each vector and, of the
   links, only the joins that hold its groups together. A pair seen from both sides counts
   once for each; one seen from one side counts for both.

Vectors that are null, empty, zero or have null or non-finite components, and those
without an id, link with nothing. Vectors of unlike lengths do not link. Repeated rows
are vectors of their own, linked with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.graph import components
from sightline.session import materialise

SAMPLE = 10_000
RECALL = 0.98
BLOCK = 4096
_ROWS = 512
_CELLS = 1 << 20  # sums of distances at once


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means centres, at most k; empty ones keep their place."""
    centres = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        own = distances(x, centres).argmin(1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


def nearest_cells(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """The n cells with the smallest distance sums, nearest first (fewer, if the grid has fewer).

    The cell at ranks (i, j) of the halves comes after (i + 1)(j + 1) - 1 others, so only ranks
    with a product up to n are looked at.
    """
    half = x.shape[1] // 2
    near = []
    for part, book in ((x[:, :half], books[0]), (x[:, half:], books[1])):
        d = distances(part, book)
        order = np.argsort(d, axis=1, kind="stable")[:, :n]
        near.append((order, np.take_along_axis(d, order, 1)))
    (first, d1), (second, d2) = near
    ranks = np.argwhere(np.outer(np.arange(1, first.shape[1] + 1), np.arange(1, second.shape[1] + 1)) <= n)
    sums = d1[:, ranks[:, 0]] + d2[:, ranks[:, 1]]
    best = np.argsort(sums, axis=1, kind="stable")[:, :n]
    return np.take_along_axis(first[:, ranks[:, 0]] * len(books[1]) + second[:, ranks[:, 1]], best, 1)


def cell_places(a: np.ndarray, b: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """At which place, from 0, each row of ``a`` meets the nearest cell of that row of ``b``; the last place of equal distances."""
    half, rows = a.shape[1] // 2, max(1, _CELLS // (len(books[0]) * len(books[1])))
    out = []
    for at in range(0, len(a), rows):
        x, y = a[at: at + rows], b[at: at + rows]
        d1, d2 = distances(x[:, :half], books[0]), distances(x[:, half:], books[1])
        i, j = np.divmod(nearest_cells(y, books, 1), len(books[1]))
        sums = np.take_along_axis(d1, i, 1) + np.take_along_axis(d2, j, 1)
        out.append((d1[:, :, None] + d2[:, None, :] <= sums[:, :, None]).sum((1, 2)) - 1)
    return np.concatenate(out)


def cells_to_visit(x: np.ndarray, books: tuple, threshold: float, recall: float, rng: np.random.Generator) -> int:
    """Smallest number of cells, up to the whole grid, that meets ``recall`` on the sample."""
    at = rng.permutation(len(x))[:1000]
    aside = rng.standard_normal((len(at), x.shape[1]))
    aside -= (aside * x[at]).sum(1)[:, None] * x[at]
    aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
    pairs = [(x[at], threshold * x[at] + np.sqrt(1 - threshold**2) * aside)]
    near = x[at] @ x.T >= threshold
    near[np.arange(len(at)), at] = False
    i, j = np.nonzero(near)
    pick = rng.permutation(len(i))[:4000]
    pairs.append((x[at][i[pick]], x[j[pick]]))
    return max(1 + int(np.quantile(cell_places(a, b, books), recall, method="higher")) for a, b in pairs if len(a))


def _unit(raw: list[bytes], dtype: str, width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(v.ljust(width * np.dtype(dtype).itemsize, b"\0") for v in raw), dtype).reshape(len(raw), width)
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(batch: pa.RecordBatch, dtype: str) -> list[bytes]:
    column = batch.column("v")
    flat, at = np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False).astype(dtype)), column.offsets.to_numpy()
    return [flat[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]


def _index(shared, dtype: str, width: int):
    """First pass: the nearest cell of each class, with its other cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, n = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _vectors(batch, dtype)
            # with the whole grid to visit, the nearest cell is all that is kept
            whole = n >= len(books[0]) * len(books[1])
            rows = min(_ROWS, max(1, _CELLS // n))
            cells = np.concatenate([nearest_cells(_unit(raw[i: i + rows], dtype, width), books, 1 if whole else n)
                                    for i in range(0, len(raw), rows)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid"), batch.column("times"), pa.array([len(v) for v in raw], pa.int32()), pa.array(raw, pa.binary()),
                 pa.array(cells[:, 0].astype(np.int32)), pa.array(cells.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                ["sid", "times", "size", "raw", "cell", "cells"])

    return run


def _deal(shared, whole: bool):
    """Second pass: one row as member of its block and one for every block it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, spread = shared.value
        every = list(range(int((first + spread).max()))) if whole else []
        for batch in batches:
            row, block, visits, homes, targets = [], [], [], [], []
            sids = batch.column("sid").to_pylist()
            for i, (sid, cell, cells) in enumerate(zip(
                    sids, batch.column("cell").to_pylist(), batch.column("cells").to_pylist(), strict=True)):
                home = int(first[cell]) + sid % int(spread[cell])
                to = every if whole else sorted({int(first[c]) + s for c in cells for s in range(int(spread[c]))})
                for b, v in [(home, False), *((t, True) for t in to)]:
                    row.append(i)
                    block.append(b)
                    visits.append(v)
                    homes.append(home)
                    targets.append(to if not v else None)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(visits, pa.bool_()), batch.column("sid").take(at), batch.column("times").take(at),
                 batch.column("size").take(at), batch.column("raw").take(at), pa.array(homes, pa.int32()),
                 pa.array(targets, pa.list_(pa.int32()))],
                ["block", "visits", "sid", "times", "size", "raw", "home", "to"])

    return run


def _compare(dtype: str, width: int, threshold: float):
    """Rows come sorted by block, members first. Gives (a, null, links of a) and (a, b, null) for joins."""

    def joined(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Each row and column of a hit with the smallest id of its group."""
        rows, columns = np.flatnonzero(hits.any(1)), np.flatnonzero(hits.any(0))
        if not len(rows):
            return []
        h, top = hits[np.ix_(rows, columns)], np.iinfo(np.int64).max
        a, b = left[rows], right[columns]
        low_a, low_b = a, b
        while True:
            new_a = np.minimum(low_a, np.where(h, low_b, top).min(1))
            new_b = np.minimum(low_b, np.where(h, new_a[:, None], top).min(0))
            if (new_a == low_a).all() and (new_b == low_b).all():
                return list(zip(np.concatenate((a, b)).tolist(), np.concatenate((low_a, low_b)).tolist(), strict=True))
            low_a, low_b = new_a, new_b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, x, goes = None, {}, None, None
        names = ("sid", "times", "size", "home")

        for batch in batches:
            if not batch.num_rows:
                continue
            out_a, out_b, out_n = [], [], []
            blocks, visits = batch.column("block").to_numpy(), batch.column("visits").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(blocks) != 0) | (visits[1:] != visits[:-1]), [True])))
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                part = batch.slice(i, j - i)
                rows = {c: part.column(c).to_numpy() for c in names}
                y = _unit(part.column("raw").to_pylist(), dtype, width)
                if not visits[i]:
                    to = part.column("to").to_pylist()
                    if block == blocks[i]:  # members that came in several batches
                        members = {c: np.concatenate((members[c], rows[c])) for c in names}
                        x, goes = np.concatenate((x, y)), goes + to
                    else:
                        block, members, x, goes = blocks[i], rows, y, to
                    continue
                if block != blocks[i]:
                    continue  # a block without members
                for at in range(0, len(y), _ROWS):
                    q = {c: v[at: at + _ROWS] for c, v in rows.items()}
                    hits = (y[at: at + _ROWS] @ x.T >= threshold) & (q["sid"][:, None] != members["sid"]) & (
                        q["size"][:, None] == members["size"])
                    if not hits.any():
                        continue
                    seen = hits @ members["times"]
                    out_a += q["sid"][seen > 0].tolist()
                    out_n += seen[seen > 0].tolist()
                    homes, home = np.unique(q["home"], return_inverse=True)
                    met = np.flatnonzero(hits.any(0))
                    back = np.array([np.isin(homes, goes[m]) for m in met])[:, home].T
                    one_way = q["times"] @ (hits[:, met] & ~back)
                    out_a += members["sid"][met][one_way > 0].tolist()
                    out_n += one_way[one_way > 0].tolist()
                    out_b += [None] * (len(out_n) - len(out_b))
                    for a, b in joined(hits, q["sid"], members["sid"]):
                        out_a.append(a)
                        out_b.append(b)
                        out_n.append(None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out_n, pa.int64())], ["a", "b", "n"])

    return run


def _number(salt: int) -> Column:
    return F.xxhash64("v") if not salt else F.xxhash64(F.lit(salt), F.col("v"))


def identified(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with sid, one row per different vector: sid, v, times, low). Rows are grouped by the vector itself; a
    number that two vectors share is drawn again, so equal numbers mean equal vectors."""
    base, salt = base.withColumn("sid", F.when(F.col("v").isNotNull(), _number(0))), 0
    while True:
        classes = materialise(base.filter("v is not null").groupBy("sid", "v").agg(
            F.count("*").alias("times"), F.min("vec_id").alias("low")), "vector-classes")
        shared = materialise(classes.groupBy("sid").count().filter("count > 1").select("sid", F.lit(True).alias("again")), "shared-numbers")
        if shared.isEmpty():
            return base, classes
        salt += 1
        base = base.join(shared, "sid", "left").withColumn(
            "sid", F.when(F.col("again"), _number(salt)).otherwise(F.col("sid"))).drop("again")


def link_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK, seed: int = 0,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector; ``vectors`` has vec_id and embedding, others are left out."""
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"
    good = F.expr("vec_id is not null and embedding is not null and size(embedding) > 0 and "
                  "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and "
                  "exists(embedding, x -> x <> 0)")
    base = vectors.select(
        F.col("vec_id").cast("long"), F.when(F.coalesce(good, F.lit(False)), F.col("embedding")).alias("v"))
    base, classes = identified(base)
    told = classes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()

    def alone(rows: DataFrame) -> DataFrame:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))

    if not told.n:
        return alone(base)
    width, rng = told.width + told.width % 2, np.random.default_rng(seed)
    picked = classes.orderBy(F.xxhash64("sid"), "sid").limit(sample).select("v").toArrow().combine_chunks().to_batches()[0]
    x = _unit(_vectors(picked, dtype), dtype, width)
    size = int(min(max(8, 2 * round(told.n**0.25)), len(x)))
    books = codebook(x[:, : width // 2], size, rng), codebook(x[:, width // 2:], size, rng)
    visits = cells_to_visit(x, books, threshold, recall, rng)
    shared = spark.sparkContext.broadcast((books, visits))
    indexed = materialise(classes.select("sid", "times", "v").mapInArrow(
        _index(shared, dtype, width), "sid long, times long, size int, raw binary, cell int, cells array<int>"), "vector-cells")

    # one row for each cell of the grid
    held = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for cell, n in indexed.groupBy("cell").count().collect():
        held[cell] = n
    first, spread, at, room = np.zeros(len(held), np.int64), np.ones(len(held), np.int64), 0, block
    for cell, n in enumerate(held.tolist()):
        if n > room and room < block:
            at, room = at + 1, block
        first[cell], spread[cell] = at, max(1, -(-n // block))
        if n > block:
            at, room = at + int(spread[cell]), block
        else:
            room -= n
    grid = spark.sparkContext.broadcast((first, spread))
    dealt = indexed.mapInArrow(_deal(grid, visits >= len(held)), "block int, visits boolean, sid long, times long, size int, raw binary, home int, to array<int>")
    found = materialise(
        dealt.repartition(max(at + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "block")
        .sortWithinPartitions("block", "visits").mapInArrow(_compare(dtype, width, threshold), "a long, b long, n long"), "vector-links")

    counts = found.filter("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    groups = components(found.filter("b is not null").select("a", "b"))
    placed = classes.select("sid", "times", "low").join(groups.toDF("sid", "component"), "sid", "left").join(
        counts.toDF("sid", "n"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    lows = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    told = placed.join(lows, "component").select(
        "sid", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    linked = base.filter("sid is not null").select("vec_id", "sid").join(told, "sid").select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return linked.unionByName(alone(base.filter("sid is null")))
