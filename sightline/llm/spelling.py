"""Spelling variants: words one edit apart, by blocked Gram matrices of letter counts.

A word's letter counts are a vector. One replaced letter moves it by a squared distance
of 2 at the same length, one letter more or less by 1 at the next length; so words more
than 2 apart are no variants.

1. Runs of letters are counted in each task and added up; rare and short words go.
2. Words are laid in blocks by length and by how many of their letters belong to each of
   ``CLASSES`` classes (code point modulo ``CLASSES``). One edit moves at most one letter
   out of a class and one into a class, so only blocks a step apart are compared, those of
   one length and of the next. A block over ``PIECE`` words is cut by a hash, and all pairs of its pieces
   are compared, each pair in a row of its own.
3. Squared distances of two blocks are ``|a|**2 + |b|**2 - 2 a.b``, where the products are
   one matrix multiplication. Pairs at most 2 apart are then held letter by letter.
4. The near word with the largest count is a word's form, if it is twice as frequent at
   least. Counts double at each step, so the way to the root is short; it is found by
   halving: each round replaces a word's target by the target's target.

Null, empty texts and texts without letters have no words. A null doc_id counts as an
empty one in the hash. Repeated rows count as often as they come. No words: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import materialise

LETTERS = "[A-Za-zÀ-ÿ]+"
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
CLASSES = 7
PIECE = 1024
_KEYS = 200_000
_ALPHABET = [*map(chr, range(ord("a"), ord("z") + 1)), *map(chr, range(0xC0, 0x100))]


def _spoiled(word: str, prefix: int, one_in: int) -> str:
    """The word with one letter removed where its hash says so."""
    h = zlib.crc32(word.encode(), prefix)
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _counts(least: int, one_in: int):
    letters = re.compile(LETTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                prefix = zlib.crc32(f"{doc_id.as_py()}:".encode() if doc_id.is_valid else b":")
                for word, n in Counter(letters.findall(text.as_py().translate(LOWER))).items():
                    word = _spoiled(word, prefix, one_in)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > _KEYS:
                    yield rows()
                    total.clear()
        yield rows()

    return run


def words(documents: DataFrame, least: int = 5, times: int = 3, one_in: int = 97) -> DataFrame:
    """(word, n): words of at least ``least`` letters, met ``times`` times or more."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counts(least, one_in), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def blocks(counted: DataFrame, piece: int = PIECE) -> DataFrame:
    """(cell, piece, words, ns): cell has the letters of each class, their sum is the length; a piece about ``piece`` words."""
    of_class = ["".join(c for c in _ALPHABET if ord(c) % CLASSES == k) for k in range(CLASSES)]
    cell = F.array(*[(F.length("word") - F.length(F.translate("word", s, ""))).cast("int") for s in of_class])
    placed = materialise(counted.select("word", "n", cell.alias("cell")), "words-by-letters")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / piece).cast("int").alias("pieces"))
    return placed.join(sizes, "cell").groupBy("cell", F.expr("cast(pmod(xxhash64(word), pieces) as int)").alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("word", "n"))).alias("rows")).select(
            "cell", "piece", F.col("rows.word").alias("words"), F.col("rows.n").alias("ns"))


def block_pairs(laid: DataFrame) -> DataFrame:
    """Rows of two blocks that may hold near words: the same one, or a step apart; each pair of blocks once."""
    steps = [(-1, -1), *((-1, j) for j in range(CLASSES)), *((i, j) for i in range(CLASSES) for j in range(i + 1, CLASSES))]
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("out"), F.lit(j).alias("in")) for i, j in steps]))
    left = laid.select(F.col("cell").alias("own"), "piece", "words", "ns", step.alias("step"))
    moved = F.transform("own", lambda v, i: v + F.when(i == F.col("step.in"), 1).when(i == F.col("step.out"), -1).otherwise(0))
    left = left.withColumn("cell", moved).filter(F.forall("cell", lambda v: v >= 0))
    right = laid.toDF("cell", "piece2", "words2", "ns2")
    same = F.col("step.in") == -1
    return left.join(right, "cell").filter(~same | (F.col("piece") <= F.col("piece2"))).select(
        (same & (F.col("piece") == F.col("piece2"))).alias("itself"), "own", "piece", "words", "ns", "words2", "ns2")


class _Block:
    """Letters and letter counts of some words."""

    def __init__(self, found: list[str]) -> None:
        self.letters = np.array([w.encode("latin-1") for w in found])
        self.size = self.letters.dtype.itemsize
        self.letters = self.letters.view(np.uint8).reshape(len(found), self.size)
        self.length = (self.letters != 0).sum(axis=1)
        flat = np.arange(len(found))[:, None] * 256 + self.letters
        self.counts = np.bincount(flat.ravel(), minlength=256 * len(found)).reshape(-1, 256)
        self.counts[:, 0] = 0
        self.used = np.flatnonzero(self.counts.any(axis=0))


def _near(a: _Block, b: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose words are one edit apart; a word of b is as long or one letter longer."""
    used = np.union1d(a.used, b.used)
    # letter counts up to 4096 have exact products in single precision
    kind = np.float32 if max(a.size, b.size) <= 4096 else np.float64
    x, y = a.counts[:, used].astype(kind), b.counts[:, used].astype(kind)
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(apart <= 2)
    keep = np.zeros(len(i), bool)
    longer = b.length[j] - a.length[i]
    same = np.flatnonzero(longer == 0)
    if len(same) and a.size == b.size:
        keep[same] = (a.letters[i[same]] != b.letters[j[same]]).sum(axis=1) == 1
    one = np.flatnonzero(longer == 1)
    if len(one):
        short, long = a.letters[i[one]], b.letters[j[one]]
        size = min(a.size, b.size - 1)  # equal lengths in a block, so no padding
        head = np.cumprod(short[:, :size] == long[:, :size], axis=1).sum(axis=1)
        tail = np.cumprod((short[:, :size] == long[:, 1: size + 1])[:, ::-1], axis=1).sum(axis=1)
        keep[one] = head + tail >= size
    return i[keep], j[keep]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, left = None, None
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for row in range(batch.num_rows):
            itself, own, piece, words_, ns, words2, ns2 = (batch.column(i)[row] for i in range(7))
            at = (tuple(own.as_py()), piece.as_py())
            if at != key:
                key, found = at, words_.as_py()
                left, left_words, left_ns = _Block(found), np.array(found, object), np.array(ns.as_py())
            right_words, right_ns = (left_words, left_ns) if itself.as_py() else (np.array(words2.as_py(), object), np.array(ns2.as_py()))
            i, j = _near(left, left if itself.as_py() else _Block(right_words.tolist()))
            if itself.as_py():
                i, j = i[i < j], j[i < j]
            for part, values in zip(out, (left_words[i], left_ns[i], right_words[j], right_ns[j]), strict=True):
                part.append(values)
        if out[0]:
            a, n, b, m = (np.concatenate(x) for x in out)
            for one, count, other, other_count in ((a, n, b, m), (b, m, a, n)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.tolist(), pa.string()), pa.array(count.tolist(), pa.int64()),
                     pa.array(other.tolist(), pa.string()), pa.array(other_count.tolist(), pa.int64())],
                    ["word", "n", "near", "near_n"])


def near_words(counted: DataFrame, piece: int = PIECE) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, both ways."""
    laid = materialise(blocks(counted, piece), "letter-blocks")
    return block_pairs(laid).mapInArrow(_pairs, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): forms followed to the last. A form must not lead back to its word."""
    reached = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reached.toDF("root", "next")
        step = materialise(reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return reached


def variants(documents: DataFrame, least: int = 5, times: int = 3, one_in: int = 97, factor: int = 2, piece: int = PIECE) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word."""
    counted = materialise(words(documents, least, times, one_in), "words")
    best = near_words(counted, piece).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    likely = -F.col("best.minus") >= factor * F.col("n")
    told = materialise(counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.minus")).alias("form_n")), "word-forms")
    ends = roots(told.filter("form is not null"))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
