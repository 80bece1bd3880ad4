"""Packing documents into sequences of fixed length by minimum bin slack.

Each document is cut into full sequences and a rest. The rests are packed by their
lengths only, of which there are fewer than the capacity, so their histogram is all
that the driver sees. While rests remain, the longest one opens a sequence; subset sums
of the others, as bits of one integer, tell how close to the capacity it can be filled,
and walking back through them gives how many of each length do so. That multiset is used
as often as the counts allow, which uses up a length. So the plan has at most some
thousand lines for any number of documents.

Rests are numbered within their length in two steps, a count for each file part and a
place inside it, so that a common length is no single task. Number and plan give
sequence and offset by a join on length. Full pieces get the sequence ids after those.

Null and empty texts are the one end token. Repeated rows are packed each. No rows: no
pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.tokens import vocabulary_path, whole_ids
from sightline.session import materialise

CAPACITY = 1024


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of lengths, at most ``counts`` of each, with the largest sum up to ``room``."""
    cover = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        steps.append((length, reached))
        for _ in range(min(counts[length], room // length)):
            more = reached | (reached << length) & cover
            if more == reached:
                break
            reached = more
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Lines (length, first number, count, first sequence, offset): number i of a length goes to
    sequence first + (i - first number) at the offset. Every number of every length is in one line."""
    left, used = {n: c for n, c in counts.items() if c}, dict.fromkeys(counts, 0)
    lines, sequence = [], 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        chosen = fullest({n: c for n, c in rest.items() if c}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        offset = 0
        for n in sorted(chosen, reverse=True):
            for _ in range(chosen[n]):
                lines.append((n, used[n], times, sequence, offset))
                used[n] += times
                offset += n
            left[n] -= times * chosen[n]
            if not left[n]:
                del left[n]
        sequence += times
    return lines


def _cut(path: str, capacity: int):
    names = ["doc_id", "h", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = whole_ids(text.as_py(), path)
                for at in range(0, len(ids), capacity):
                    piece = ids[at: at + capacity]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("h").take(at),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], names)

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with length, from 1 to ``capacity``, and columns that tell its rows apart)
    with sequence_id and offset."""
    others = [c for c in pieces.columns if c != "length"]
    pieces = materialise(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    # one row for each length and part
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = counts.pop(capacity, 0)
    lines = plan(counts, capacity)
    sequences = max((line[3] + line[2] for line in lines), default=0)
    if full:
        lines.append((capacity, 0, full, sequences, 0))
    within = Window.partitionBy("length", "part").orderBy(*others)
    numbered = pieces.withColumn("number", F.row_number().over(within) - 1).join(bases, ["length", "part"]).withColumn(
        "number", F.col("number") + F.col("base"))
    # the lines of one length as a sorted list: at most as many as the plan has
    listed = pieces.sparkSession.createDataFrame(lines, "length long, first long, n long, sequence long, offset long").groupBy(
        "length").agg(F.array_sort(F.collect_list(F.struct("first", "n", "sequence", "offset"))).alias("lines"))
    return numbered.join(F.broadcast(listed), "length").withColumn("line", F.expr(
        "filter(lines, x -> number >= x.first and number < x.first + x.n)[0]")).select(
        *others, "length", (F.col("line.sequence") + F.col("number") - F.col("line.first")).alias("sequence_id"),
        F.col("line.offset").alias("offset"))


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    ``documents`` has doc_id and text; other columns are left out.
    """
    base = documents.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    pieces = base.mapInArrow(
        _cut(path or vocabulary_path(), capacity),
        "doc_id long, h long, start long, length long, ids_crc32 long, doc_tokens long")
    return place(pieces, capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
