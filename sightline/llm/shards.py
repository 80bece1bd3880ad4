"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride binary shards.

1. Every text becomes ids with an end token, cut into sequences of ``stride`` ids, the
   last one filled up with the end token. They are written once, up to ``PER_BLOCK``
   sequences of a document in a row, and numbered 0..n-1 in the order of id (null first),
   hash of the text, copy and place. Documents are counted for that, not sequences
   sorted: running sums within ranges of ids, and the sums of the ranges before. Copies
   are alike, so which one comes first does not matter: each task counts its own, and a
   running sum over the tasks gives the first number of each. So a number follows from
   the rows alone, however they are dealt over files and tasks, and the ids move once,
   to their shard (twice, where the numbers of the documents are too many to broadcast;
   then they are written in between, and what was written and shuffled before is dropped).
2. A keyed Feistel permutation with cycle-walking sends the number of each sequence to
   its global slot: one to one, without a random column, the same on a rerun.
3. Shard s holds slots s * per_shard up to (s + 1) * per_shard - 1, in order. The number of
   slots is known, so each row is dealt to the task of its shard without a sample, and each
   task writes whole shards, one after the other.
4. A shard file is a header (magic, ids per sequence, first slot, number of slots; four
   unsigned 64-bit integers) and the ids, unsigned 16 bit, little-endian. Slot g is at a
   known byte, so a reader can go on from any place with one seek. A file is one
   binary value of a Parquet table: Spark commits it whole, a task that is run again
   replaces it, and any store that Spark writes to will do. Beside it stands the shard's
   index: which sequence of which document is in each slot.

Null and empty texts are one sequence with the end token. Repeated rows are sequences of
their own. No rows: no shards.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.permute import permute
from sightline.llm.tokens import vocabulary_path, whole_ids
from sightline.session import discard, materialise, shuffles_dropped

STRIDE = 256
PER_BLOCK = 64  # a row stays small however long its document
PER_SHARD = 4096
MAGIC = 0x53484152445F3031
COMPRESSION = "zstd"  # ids repeat as symbols, not as strings: 77 MB where snappy takes 104
_HEADER = np.dtype("<u8")


def _cut(path: str, stride: int):
    names = ["doc_id", "h", "part", "copy", "start", "ids"]
    block = stride * PER_BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Counter()  # one entry for each document of the task
        for batch in batches:
            row, copy, start, data = [], [], [], []
            for i, (text, *document) in enumerate(zip(*(batch.column(c) for c in ("text", "doc_id", "h")), strict=True)):
                ids = whole_ids(text.as_py(), path).astype("<u2")
                document = tuple(x.as_py() for x in document)
                for at in range(0, len(ids), block):
                    row.append(i)
                    copy.append(met[document])
                    start.append(at)
                    data.append(ids[at: at + block].tobytes())
                met[document] += 1
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in names[:3]), pa.array(copy, pa.int64()), pa.array(start, pa.int64()),
                 pa.array(data, pa.binary())], names)

    return run


def _bytes(ids: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Where the values begin in the buffer, and where the last one ends; and the buffer."""
    _, ends, data = ids.cast(pa.binary()).buffers()
    return np.frombuffer(ends, np.int32)[ids.offset: ids.offset + len(ids) + 1], data


def _spread(n: int, key: int, stride: int):
    """Blocks to sequences, each with its slot."""
    names = ["slot", "doc_id", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends, data = _bytes(batch.column("ids"))
            pieces = -(-np.diff(ends) // (2 * stride))
            row = np.repeat(np.arange(len(pieces)), pieces)
            k = np.arange(len(row)) - (np.cumsum(pieces) - pieces)[row]
            cuts = np.append(ends[row] + 2 * stride * k, ends[-1]).astype(np.int32)  # blocks lie one behind the other
            number = batch.column("number").to_numpy()[row] + k
            yield pa.RecordBatch.from_arrays(
                [pa.array(permute(number, n, key), pa.int64()), batch.column("doc_id").take(pa.array(row)),
                 pa.array(batch.column("start").to_numpy()[row] + stride * k, pa.int64()),
                 pa.array(np.diff(cuts) // 2, pa.int32()),
                 pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), data])], names)

    return run


def _first_numbers(cut: DataFrame, stride: int) -> tuple[DataFrame, int]:
    """(doc_id, h, part, n, base) and the number of all sequences: sequences of one copy of a document, and the number
    of the first one of its copies in a task."""
    spark = cut.sparkSession
    sequences = F.expr(f"(length(ids) div 2 + {stride - 1}) div {stride}")
    counted = materialise(cut.groupBy("doc_id", "h", "part").agg(
        F.sum(sequences).alias("here"), F.count_if(F.col("start") == 0).alias("copies")), "document-sequences")
    documents = counted.groupBy("doc_id", "h").agg(F.sum("here").alias("all"))
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(documents.repartitionByRange(n_ranges, "doc_id", "h").withColumn("range", F.spark_partition_id()), "document-ranges")
    before, bases = 0, []
    for number, n in dealt.groupBy("range").agg(F.sum("all")).orderBy("range").collect():  # one row for each range
        bases.append((number, before))
        before += n
    within = Window.partitionBy("range").orderBy("doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.join(F.broadcast(spark.createDataFrame(bases, "range int, base long")), "range").select(
        "doc_id", "h", (F.col("base") + F.coalesce(F.sum("all").over(within), F.lit(0))).alias("base"))
    earlier = Window.partitionBy("doc_id", "h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counted.withColumn("earlier", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    p, f = parts.alias("p"), first.alias("f")
    met = p.join(f, F.col("p.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("p.h") == F.col("f.h")))
    return materialise(met.select(
        "p.doc_id", "p.h", "part", F.expr("here div copies").alias("n"), (F.col("base") + F.col("earlier")).alias("base")),
        "first-numbers"), before


def _ordered(documents: DataFrame, key: int, path: str | None, stride: int) -> tuple[DataFrame, int]:
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
        F.spark_partition_id().alias("part"), "text")
    cut = materialise(base.mapInArrow(
        _cut(path or vocabulary_path(), stride), "doc_id long, h long, part int, copy long, start long, ids binary"), "sequences", COMPRESSION)
    first, total = _first_numbers(cut, stride)
    c, f = cut.alias("c"), first.alias("f")
    met = c.join(f, F.col("c.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("c.h") == F.col("f.h")) & (F.col("c.part") == F.col("f.part")))
    number = (F.col("base") + F.col("copy") * F.col("n") + F.expr(f"start div {stride}")).alias("number")
    # written, so the shuffle that brought the numbers is gone when the ids move to their shards
    numbered = materialise(met.select("c.doc_id", number, "start", "ids"), "numbered-sequences", COMPRESSION)
    discard(cut)
    return numbered.mapInArrow(
        _spread(total, key, stride), "slot long, doc_id long, start long, length int, ids binary"), total


def ordered(documents: DataFrame, key: int = 1, path: str | None = None, stride: int = STRIDE) -> DataFrame:
    """(slot, doc_id, start, length, ids): every sequence with its place in training order; slots have no gap."""
    return _ordered(documents, key, path, stride)[0]


def _files(stride: int, per_shard: int):
    names = ["shard", "n_sequences", "first_slot", "n_tokens", "crc32", "data", "index"]
    entry = pa.struct([("slot", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("crc32", pa.int64())])

    def emit(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        slots, length = (rows.column(c).to_numpy() for c in ("slot", "length"))
        first = shard * per_shard
        if not np.array_equal(slots, np.arange(first, first + len(slots))):
            raise ValueError(f"shard {shard} has a gap")
        ends, buffer = _bytes(rows.column("ids"))
        flat = np.frombuffer(buffer, np.uint8)
        body = np.zeros((len(slots), 2 * stride), np.uint8)
        body[np.arange(2 * stride) < 2 * length[:, None]] = flat[ends[0]: ends[-1]]
        data = np.array([MAGIC, stride, first, len(slots)], _HEADER).tobytes() + body.tobytes()
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        index = pa.StructArray.from_arrays([*(rows.column(c) for c in entry.names[:4]), pa.array(sums, pa.int64())], fields=list(entry))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([len(slots)], pa.int64()), pa.array([first], pa.int64()),
             pa.array([int(length.sum())], pa.int64()), pa.array([zlib.crc32(data)], pa.int64()),
             pa.array([data], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(slots)], pa.int32()), index)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column("slot").to_numpy() // per_shard
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if of[a] != shard:
                    if parts:
                        yield emit(shard, parts)
                    shard, parts = int(of[a]), []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield emit(shard, parts)

    return run


def write_shards(
    documents: DataFrame, to: str | None = None, key: int = 1, path: str | None = None, stride: int = STRIDE,
    per_shard: int = PER_SHARD,
) -> DataFrame:
    """Writes the shards and returns the table, one row per shard: shard, n_sequences, first_slot, n_tokens, crc32, data, index.

    ``n_tokens`` counts ids without the filling. ``index`` has slot, doc_id, start, length and crc32 (of its ids) of each sequence. ``to`` names a folder; without it the
    table is kept among the session's intermediate ones.
    """
    spark = documents.sparkSession
    rows, total = _ordered(documents, key, path, stride)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // per_shard))
    task = F.expr(f"cast((slot div {per_shard}) * {n} div {shards} as int)")
    files = rows.repartitionById(n, task).sortWithinPartitions("slot").mapInArrow(
        _files(stride, per_shard), "shard long, n_sequences long, first_slot long, n_tokens long, crc32 long, data binary, "
        "index array<struct<slot: long, doc_id: long, start: long, length: int, crc32: long>>")
    if to is None:
        return materialise(files, "shards", COMPRESSION)
    with shuffles_dropped(spark):
        files.write.parquet(to, compression=COMPRESSION)
    return spark.read.schema(files.schema).parquet(to)


def sequences(shards: DataFrame) -> DataFrame:
    """(shard, slot, doc_id, start, length, crc32), one row per sequence, from the written shards' indexes."""
    return shards.select("shard", F.inline("index"))


def read_slots(shards: DataFrame, begin: int, end: int, stride: int = STRIDE, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, ids) of the slots from ``begin`` up to ``end``, exclusive; reads only the shards that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                _, width, first, n = np.frombuffer(data, _HEADER, 4)
                ids = np.frombuffer(data, "<u2", offset=32).reshape(int(n), int(width))
                slots = np.arange(int(first), int(first + n))
                at = np.flatnonzero((slots >= begin) & (slots < end))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots[at]), pa.array(ids[at].astype(np.int32).tolist(), pa.list_(pa.int32()))], ["slot", "ids"])

    wanted = shards.filter((F.col("shard") >= begin // per_shard) & (F.col("shard") * per_shard < end))
    return wanted.select("data").mapInArrow(run, "slot long, ids array<int>")
