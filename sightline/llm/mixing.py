"""Mixing sources to target weights, in fixed-length blocks of words.

1. Sources in order of code point, null last, get weights in turn. Together they share
   ``share`` of all words; a target stops at ``most`` times its source's size and what is
   over goes to the others by weight. The sizes of the sources, one number each, are all
   that the driver sees.
2. The documents of a source are laid end to end, in an order by hash, and cut into
   blocks of ``block_words``, or of a ``FEWEST``-th of a small source. Their places are running sums within parts of a source plus
   the sums of the parts before, so a source with a third of all rows is no single task.
3. A source has all its blocks as slots for each time round that its target holds whole,
   and the rest of the target / block_words. So a whole time round takes its exact words,
   and the rest is met to one and a half blocks. The output shards draw their counts of slots
   per source from a multinomial over the slots not drawn yet; the last shard takes what
   is left, so the totals are exact.
4. Slot t of a source takes block p(t mod blocks), where p is a keyed permutation, another
   one for each time round. So a block is taken ``most`` times at most, and as often as
   any other block of its source, or once more.
5. The slots are a written table, and documents meet their blocks in a join on source and
   block. The result is the mix: every output shard with its slots and the words that each
   takes of each document. What is taken of a document is the sum over its rows.

Everything follows from the rows and the seed; reruns agree. Null, empty and blank texts
have no words: target 0 for a source of nothing else. Repeated rows are documents of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.columns import document_key, key_of, unused
from sightline.llm.permute import permute
from sightline.session import materialise

WEIGHTS = (3, 1, 2)
WORDS = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
FEWEST = 32
SHARDS = 64
PART_ROWS = 4_000
_CHUNK = 1 << 18


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    out, free = [0.0] * len(sizes), list(range(len(sizes)))
    while free:
        unit = max(0.0, total - sum(out)) / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > most * sizes[i]]
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else unit * weights[i]
        free = [i for i in free if i not in set(over)] if over else []
    return out


def draw_counts(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source (column) in each shard (row): multinomial over those left, the last shard gets the rest."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for i in range(shards):
        want = int(left.sum()) // (shards - i)
        drawn = np.minimum(rng.multinomial(want, left / left.sum()), left) if left.sum() else left * 0
        out[i] = left if i == shards - 1 else drawn
        left = left - out[i]
    return out


def _slots(seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                for at in range(r.begin, r.begin + r.n, _CHUNK):
                    t = np.arange(at, min(at + _CHUNK, r.begin + r.n))
                    block = np.empty_like(t)
                    for turn in np.unique(t // r.blocks):
                        now = t // r.blocks == turn
                        block[now] = permute(t[now] % r.blocks, r.blocks, seed + 7919 * r.number + 104729 * int(turn))
                    yield pd.DataFrame({
                        "shard": r.shard, "slot": t, "number": r.number, "turn": t // r.blocks, "block": block})

    return run


def _take(names: list[str], spans_at: str):
    """Texts cut to the words of their spans; a text taken whole stays as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(spans_at).to_pylist(), strict=True):
                words = text.encode().split()
                runs: list[list[int]] = []
                for s in spans:
                    if runs and runs[-1][1] == s["from"]:
                        runs[-1][1] = s["to"]
                    else:
                        runs.append([s["from"], s["to"]])
                whole = runs == [[0, len(words)]]
                texts.append(text if whole else "\n".join(b" ".join(words[i:j]).decode() for i, j in runs))
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            yield out.select(names)

    return run


class Mix:
    """``documents`` (doc_id, source, text) mixed; ``placed``, ``slots`` and ``taken`` are its tables."""

    def __init__(
        self, documents: DataFrame, share: float = 1.5, most: int = 2, weights: tuple = WEIGHTS, seed: int = 0,
        block_words: int = BLOCK_WORDS, shards: int = SHARDS,
    ) -> None:
        spark, self.documents = documents.sparkSession, documents
        sized = materialise(documents.select(
            F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
            F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "sizes")
        found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
        sizes = [r["size"] for r in found]
        want = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes), most)
        widths = [max(1, min(block_words, -(-s // FEWEST))) for s in sizes]
        blocks = [-(-s // k) for s, k in zip(sizes, widths, strict=True)]
        slots = [int(w // s) * b + min(b, round(w % s / k)) if s else 0 for w, s, b, k in zip(want, sizes, blocks, widths, strict=True)]
        parts = [1 + r["n"] // PART_ROWS for r in found]
        self.sources = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(zip([r.source for r in found], sizes, want, widths, blocks, slots, parts, strict=True))],
            "number int, source string, source_size long, target double, width long, blocks long, slots long, parts int")
        counts = draw_counts(slots, shards, seed)
        begins = np.cumsum(counts, axis=0) - counts
        dealt = [(i, j, blocks[j], int(begins[i, j]) + at, min(_CHUNK, int(counts[i, j]) - at))
                 for i in range(shards) for j in range(len(found)) for at in range(0, int(counts[i, j]), _CHUNK)]
        tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
        # written, so that the joins know its size; a number of tasks, as the few rows here stand for many slots
        self.slots = materialise(spark.createDataFrame(dealt, "shard int, number int, blocks long, begin long, n long").repartition(
            tasks, "shard", "number", "begin").mapInPandas(_slots(seed), "shard int, slot long, number int, turn long, block long"), "slots")

        numbered = sized.join(self.sources.select("number", "source", "width", "parts"), sized["source"].eqNullSafe(self.sources["source"])).select(
            "doc_id", "h", "size", "number", "width", F.pmod(F.xxhash64("doc_id", "h"), F.col("parts")).cast("int").alias("part"))
        sums = numbered.groupBy("number", "part").agg(F.sum("size").alias("sum"))
        earlier = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("number", "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
        within = Window.partitionBy("number", "part").orderBy("doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
        place = F.coalesce(F.sum("size").over(within), F.lit(0))
        self.placed = materialise(numbered.withColumn("begin", place).join(sums, ["number", "part"]).select(
            "doc_id", "h", "number", "width", "size", (F.col("begin") + F.col("base")).alias("begin")), "placed")
        self._pieces = self.placed.filter("size > 0").select("*", F.explode(F.expr(
            "sequence(begin div width, (begin + size - 1) div width)")).alias("block")).withColumns({
                "from": F.expr("greatest(0L, block * width - begin)"),
                "to": F.expr("least(size, (block + 1) * width - begin)")})

    @property
    def mixed(self) -> DataFrame:
        """(shard, number, slot, turn, block, begin, doc_id, h, size, from, to): the words that a slot of an output
        shard takes of a document; number is the source's, slot its place among the source's slots."""
        return self._pieces.drop("width").join(self.slots, ["number", "block"])

    @property
    def taken(self) -> DataFrame:
        """(doc_id, h, size, source, source_size, target, taken, n_shards), one row per document; n_shards: output
        shards that hold words of it."""
        keys = ["number", "begin", "doc_id", "h", "size"]
        slots = self.slots.select("number", "block", "shard")
        got = self._pieces.join(slots, ["number", "block"], "left").groupBy(*keys).agg(
            F.sum(F.when(F.col("shard").isNotNull(), F.col("to") - F.col("from")).otherwise(0)).alias("taken"),
            F.size(F.collect_set("shard")).cast("long").alias("n_shards"))
        none = self.placed.filter("size = 0").drop("width").withColumns(
            {"taken": F.lit(0).cast("long"), "n_shards": F.lit(0).cast("long")})
        return got.unionByName(none).join(self.sources, "number").select(
            "doc_id", "h", "size", "source", "source_size", "target", "taken", "n_shards")

    @property
    def spans(self) -> DataFrame:
        """(doc_id, h, begin, turn, spans): what each time round takes of a document, as (from, to) of its words."""
        return self.mixed.groupBy("number", "begin", "doc_id", "h", "turn").agg(
            F.array_sort(F.collect_list(F.struct("from", "to"))).alias("spans")).drop("number")

    @property
    def texts(self) -> DataFrame:
        """The mix as documents, all columns: a row for each time round that takes of a document, its text what is
        taken of it; n_chars follows, if there is one. What the blocks between leave out is a line break."""
        names, schema = self.documents.columns, self.documents.schema
        key, copy, cut = (unused(self.documents, stem) for stem in ("key", "copy", "spans"))
        alike = Window.partitionBy(key)
        keyed = self.documents.withColumn(key, document_key())
        keyed = keyed.withColumn(copy, F.dense_rank().over(alike.orderBy(F.monotonically_increasing_id())))
        spans = self.spans.select(key_of("doc_id", "h").alias(key), "begin", F.col("spans").alias(cut))
        spans = spans.withColumn(copy, F.dense_rank().over(alike.orderBy("begin"))).drop("begin")
        out = keyed.join(spans, [key, copy]).select(*names, cut).mapInArrow(_take(names, cut), schema)
        return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
