"""Quartile bucket digests of texts: fingerprints that differ little where texts differ little.

Every window of five UTF-8 bytes counts six of its byte triplets in hash buckets. A
bucket's two bits tell in which quarter of the text's buckets its count lies. The digest
is, in hex, the length on a log scale (2 digits), the ratios of the quartiles (2 digits)
and the buckets (2 bits each). Texts under five bytes have their bytes hashed instead of
windows, so that they still tell apart. Null is an empty text. Equal texts have equal
digests, whatever else the row holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 512
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4), (0, 1, 4), (0, 3, 4))
_ROUND_BYTES = 1_000_000
_LENGTH_STEPS = 8  # steps of the length code for a doubling


def _counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    if len(data) < 5:
        for i, x in enumerate(hashlib.sha256(data).digest() if data else b""):
            counts[(i * 16 + x) % BUCKETS] += 1
        return counts
    for at in range(0, len(data) - 4, _ROUND_BYTES):
        a = np.frombuffer(data[at: at + _ROUND_BYTES + 4], np.uint8).astype(np.uint32)
        n = len(a) - 4
        for salt, (i, j, k) in enumerate(_TRIPLETS):
            x = a[i: i + n] | a[j: j + n] << np.uint32(8) | a[k: k + n] << np.uint32(16) | np.uint32(salt << 24)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
            counts += np.bincount(x >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    data = text.encode()
    counts = _counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = np.packbits(((code[:, None] >> np.array([1, 0])) & 1).astype(np.uint8).ravel()).tobytes().hex()
    length = min(255, round(_LENGTH_STEPS * np.log2(len(data) + 1)))
    ratios = (int(q1 * 16 // max(q3, 1)) % 16) << 4 | int(q2 * 16 // max(q3, 1)) % 16
    return f"{length:02x}{ratios:02x}{body}"


def likeness(a: str, b: str) -> float:
    """From 1 for equal digests to 0, where the difference reaches that of unrelated texts.

    Buckets add the distance of their quarters, opposite quarters three more. Lengths
    and quartile ratios that differ add up to a tenth each.
    """
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    p, q = (np.unpackbits(np.frombuffer(z, np.uint8, offset=2)).reshape(-1, 2) @ np.array([2, 1]) for z in (x, y))
    gap = np.abs(p - q)
    apart = float((gap + 3 * (gap == 3)).sum()) / (1.625 * BUCKETS)  # 1.625 is the mean over independent quarters
    length = min(1.0, abs(x[0] - y[0]) / (4 * _LENGTH_STEPS))
    shape = (abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15))) / 30
    return max(0.0, 1 - apart - 0.1 * length - 0.1 * shape)


def with_next(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows (bucket, is_head, doc_id, text), sorted; each row is followed by the next document, in descending id.

    The order is by doc_id, null last, ties by text. It is cut into buckets at quantiles
    of the ids. The first row of each bucket is added to the bucket before it as a head,
    and the first row of all to the last bucket. So each text moves once, and no task
    needs more than its buckets.
    """
    spark = documents.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    above = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))).cast("array<long>"), lambda c: c < F.col("doc_id")))
    base = base.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(above))
    # one row for each bucket: the order's first id in it
    tops = base.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy(F.desc("bucket")).collect()
    heads = spark.createDataFrame(
        [(below.top, before.bucket) for before, below in zip(tops, tops[1:] + tops[:1], strict=True)],
        "top long, before int")
    added = base.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top"))).select(
        F.col("before").alias("bucket"), F.lit(True).alias("is_head"), "doc_id", "text")
    rows = base.select("bucket", F.lit(False).alias("is_head"), "doc_id", "text").unionByName(added)
    return rows.repartition(n, "bucket").sortWithinPartitions("bucket", "is_head", F.desc_nulls_last("doc_id"), "text")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket = waiting = None  # waiting: (doc_id, text, digest) of a row whose next one is to come
    for batch in batches:
        rows = []
        for where, is_head, doc_id, text in zip(*(batch.column(c) for c in range(4)), strict=True):
            where, is_head, text = where.as_py(), is_head.as_py(), text.as_py()
            if where == bucket and is_head and waiting is None:
                continue  # another row with the head's id
            own = digest(text)
            if where == bucket and waiting is not None:
                at, before, code = waiting
                half = len(before) // 2
                edited = before[: len(before) - half] + text[:half]
                changed = digest(edited)
                rows.append((at, len(before), before, edited, hashlib.sha256(edited.encode()).hexdigest(), code, changed,
                             likeness(code, changed), likeness(code, own)))
            bucket, waiting = where, None if is_head else (doc_id.as_py(), text, own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 9, _TYPES.values(), strict=True)], list(_TYPES))


_TYPES = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "text": pa.string(), "edited": pa.string(), "edited_sha256": pa.string(),
    "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


def fingerprints(documents: DataFrame) -> DataFrame:
    """Digest of each text and of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last half, rounded down, replaced by as many characters of
    the next document (fewer, if that is shorter). One row per document, other columns
    are left out; a table of one row is its own next. Equal ids are told apart by text.
    """
    return with_next(documents).mapInArrow(
        _fingerprints, "doc_id long, n_chars long, text string, edited string, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
