"""Removal of byte strings that repeat across a corpus, in suffix order by prefix-free parsing.

A window is ``n`` consecutive bytes of one document. Every byte that a repeated window
covers is removed, in each of its places.

1. Every text is parsed into phrases by a rolling hash: a trigger is the leftmost
   ``TRIGGER``-byte gram with the smallest hash of ``SPAN`` neighbours, so every window
   holds one. Windows with one trigger make a passage of at most ``SPAN`` windows, known by
   two hashes of its bytes, and filed under the bytes after its trigger that all its
   windows share. Equal windows are filed alike.
2. Passages filed alone cannot hold a repeated window and go. A passage met twice is
   repeated throughout. Different passages filed alike form a shard.
3. Each shard is put in corpus order by prefix-free parsing (``PrefixFreeParse``): its
   texts become a dictionary of phrases and a parse, each gets a suffix array, and the two
   together give the order of all suffixes without sorting the texts. Windows that repeat
   are neighbours in this order.
4. Shards over ``GROUP`` passages (a phrase in endless contexts) are cut by the place of
   the windows before the trigger. Windows of a narrower range share more bytes, so they are
   filed under longer strings, in smaller shards; in the end a shard has one window. All
   steps are the same for the parts, and nothing is dropped.
5. The repeated windows return to their documents, whose other bytes are joined.

Nothing is gathered by one key without a bound: counts combine before the shuffle, joins
on a frequent key can be split, shards hold ``GROUP`` passages at most.

Null, empty or short texts have no window and lose nothing. Repeated rows, also with one
id, are documents of their own: everything in them repeats. Texts longer than a piece are
parsed piece by piece. Other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.words import CHUNK_BYTES, chunks, gram_hashes, mix
from sightline.session import materialise

TRIGGER, SPAN = 24, 144
GROUP = 2000
PARTS = 4
_ORDER_BYTES = 500_000
_PLACE = 23  # bits of a place in a piece
KIND = ["key", "c1", "c2", "n_windows", "lead"]


# -- parsing of the corpus ----------------------------------------------------------
@lru_cache(maxsize=2)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, powers, inverse powers) of a rolling hash modulo 2**64."""
    base = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95][which]
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xF1357AEA2E62A9C5 + 2 * which)) | np.uint64(1)
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return letters, np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class _Rolling:
    """Hash of any range of a byte array."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        size = 1 << max(21, len(data).bit_length())
        letters, up, self.down = _powers(which, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * up[: len(data)], out=self.sums[1:])

    def grams(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n]

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


def _segments(texts: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(row, place in its text, bytes) of about CHUNK_BYTES at a time; a longer text comes in pieces
    that overlap by n - 1 bytes, so every window is whole in one of them."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, j in chunks(sizes, CHUNK_BYTES):
        if max(sizes[i:j]) <= 2 * CHUNK_BYTES:
            rows = [k for k in range(i, j) if sizes[k] >= n]
            yield np.array(rows, np.int64), np.zeros(len(rows), np.int64), [texts[k].as_py() for k in rows]
        else:
            text = texts[i].as_py()
            for at in range(0, len(text) - n + 1, CHUNK_BYTES):
                yield np.array([i]), np.array([at]), [text[at: at + CHUNK_BYTES + n - 1]]


def _passages(n: int, w: int, span: int):
    place_mask = np.uint64((1 << _PLACE) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, texts in _segments(batch.column("text").cast(pa.large_binary()), n):
                if not texts:
                    continue
                data = np.frombuffer(b"".join(texts), np.uint8)
                one, two = _Rolling(data, 0), _Rolling(data, 1)
                low = (mix(one.grams(w)) & ~place_mask) | np.arange(len(data) - w + 1, dtype=np.uint64)
                width = 1
                while width < span:  # smallest of ``span`` grams from each place on, the leftmost of equals
                    by = min(width, span - width)
                    low = np.minimum(low[:-by], low[by:])
                    width += by
                sizes = np.array([len(t) for t in texts])
                first = np.cumsum(sizes) - sizes
                inside = np.zeros(len(data), bool)
                for f, s in zip(first.tolist(), sizes.tolist(), strict=True):
                    inside[f: f + s - n + 1] = True
                at = np.flatnonzero(inside)
                trigger = (low[at] & place_mask).astype(np.int64)
                fresh = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(trigger) != 0)))
                begin, trigger = at[fresh], trigger[fresh]
                end = at[np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(at) - 1]))] + n
                text = np.searchsorted(first, begin, side="right") - 1
                row = pa.array(rows[text])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(row), batch.column("h").take(row),
                        pa.array((begin - first[text] + offsets[text]).astype(np.int32)),
                        pa.array(one.ranges(trigger, trigger + n - span + 1).view(np.int64)),
                        pa.array(one.ranges(begin, end).view(np.int64)), pa.array(two.ranges(begin, end).view(np.int64)),
                        pa.array((end - begin - n + 1).astype(np.int32)), pa.array((trigger - begin).astype(np.int32)),
                    ],
                    ["doc_id", "h", "start", *KIND],
                )

    return run


# -- corpus order of a shard ----------------------------------------------------------
def suffix_ranks(key: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix among all, from 1; equal suffixes get equal ranks.

    ``key`` orders suffixes by their first ``depth`` symbols, ``left`` is the number of
    symbols from each place to the end of its string. A suffix that ends sorts first.
    Prefix doubling: only suffixes not told apart yet are sorted again, by what follows.
    """
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], np.diff(key[order]) != 0)) if len(order) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((heads, [len(order)])))
    rank, alike = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    rank[order], alike[order] = np.repeat(heads, sizes) + 1, np.repeat(sizes, sizes)
    open_ = np.arange(len(key))
    while True:
        open_ = open_[(alike[open_] > 1) & (left[open_] >= depth)]
        further = left[open_] > depth
        if not further.any():
            return rank
        after = np.zeros(len(open_), np.int64)
        after[further] = rank[open_[further] + depth]
        by = np.lexsort((after, rank[open_]))
        at, follow = rank[open_][by], after[by]
        group = np.concatenate(([True], np.diff(at) != 0))
        part = group | np.concatenate(([True], np.diff(follow) != 0))
        number = np.arange(len(by))
        begin = np.maximum.accumulate(np.where(group, number, 0))
        heads = np.flatnonzero(part)
        sizes = np.diff(np.concatenate((heads, [len(by)])))
        rank[open_[by]] = at + np.repeat(heads, sizes) - begin
        alike[open_[by]] = np.repeat(sizes, sizes)
        depth *= 2


class PrefixFreeParse:
    """Suffix order of several texts from a dictionary of phrases and a parse.

    Phrases begin at the texts' begins and where the rolling hash of ``w`` symbols is a
    multiple of ``one_in``; each ends with the trigger of the next one, or with the end
    mark of its text. So no proper suffix of a phrase is the beginning of another, and
    two suffixes of the texts compare as (suffix of the phrase, parse from the next phrase).
    """

    def __init__(self, texts: list[bytes], w: int = 8, one_in: int = 16) -> None:
        sizes = np.array([len(t) + 1 for t in texts])
        self.first = np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        ends = self.first + sizes  # after the end mark
        symbols = self.data.astype(np.uint16) + np.uint16(1)
        symbols[ends - 1] = 0

        trigger = gram_hashes(mix(symbols.astype(np.uint64)), w, np.uint64(0x9E3779B97F4A7C15)) % np.uint64(one_in) == 0
        trigger &= np.repeat(ends, sizes) - np.arange(len(symbols)) > w  # whole in its text
        trigger[self.first] = True
        self.start = np.flatnonzero(trigger)
        text = np.searchsorted(self.first, self.start, side="right") - 1
        follows = np.concatenate((text[1:] == text[:-1], [False]))
        end = np.where(follows, np.concatenate((self.start[1:], [0])) + w, ends[text])

        raw, known, phrase = symbols.astype(">u2").tobytes(), {}, np.empty(len(self.start), np.int64)
        for k, (i, j) in enumerate(zip((2 * self.start).tolist(), (2 * end).tolist(), strict=True)):
            phrase[k] = known.setdefault(raw[i:j], len(known))
        dictionary = np.frombuffer(b"".join(known), ">u2").astype(np.uint64)
        lengths = np.array([len(p) // 2 for p in known], np.int64)
        begin = np.cumsum(lengths) - lengths
        left = np.repeat(begin + lengths, lengths) - np.arange(len(dictionary))
        key, padded = np.zeros(len(dictionary), np.uint64), np.concatenate((dictionary, np.zeros(7, np.uint64)))
        for k in range(7):  # seven symbols of nine bits
            key = (key << np.uint64(9)) | np.where(left > k, padded[k: k + len(dictionary)] + np.uint64(1), np.uint64(0))
        self.suffix_rank, self.suffix_left = suffix_ranks(key, left, 7), left
        self.begin = begin[phrase]

        count = np.bincount(text, minlength=len(texts))
        to_end = np.repeat(np.cumsum(count), count) - np.arange(len(phrase))
        self.parse_rank = np.where(
            follows, np.concatenate((suffix_ranks(self.suffix_rank[self.begin], to_end, 1)[1:], [0])), 0)  # of the next phrase

    def order(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places in suffix order, rank of their phrase's suffix, its length)."""
        k = np.searchsorted(self.start, places, side="right") - 1
        at = self.begin[k] + places - self.start[k]
        by = np.lexsort((self.parse_rank[k], self.suffix_rank[at]))
        return places[by], self.suffix_rank[at][by], self.suffix_left[at][by]

    def repeated(self, places: np.ndarray, n: int) -> np.ndarray:
        """Those places whose next n bytes also start at another one; each must have n bytes left in its text."""
        place, rank, left = self.order(places)
        # unequal suffixes of phrases differ within the shorter one
        pair = np.flatnonzero((rank[1:] == rank[:-1]) | ((left[1:] >= n) & (left[:-1] >= n)))
        windows = np.lib.stride_tricks.sliding_window_view(self.data, n)
        found = np.zeros(len(place), bool)
        for i in range(0, len(pair), 8192):
            some = pair[i: i + 8192]
            same = some[(windows[place[some]] == windows[place[some + 1]]).all(axis=1)]
            found[same] = found[same + 1] = True
        return place[found]


def repeated_runs(texts: list[bytes], n: int) -> list[list[tuple[int, int]]]:
    """For each text: runs (from, to) of its places whose next n bytes also start at another place of the texts."""
    parse = PrefixFreeParse(texts)
    wide = np.array([len(t) - n + 1 for t in texts])
    places = np.repeat(parse.first - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
    mark = np.zeros(len(parse.data) + 1, np.int8)
    mark[parse.repeated(places, n)] = 1
    step = np.diff(np.concatenate(([0], mark)))
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    text = np.searchsorted(parse.first, begin, side="right") - 1
    for t, i, j in zip(text.tolist(), (begin - parse.first[text]).tolist(), (end - parse.first[text]).tolist(), strict=True):
        out[t].append((i, j))
    return out


def _ordered(n: int):
    """Rows come sorted by kind; some shards at a time are put in order together. Copies of a
    document with one id bring a passage more than once; it is taken once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, ()

        def done() -> pa.RecordBatch:
            found = [(r, i, j) for r, runs in zip(rows, repeated_runs([r[6] for r in rows], n), strict=True)
                     if r[5] == 1 for i, j in runs]  # a passage met twice is known to be repeated
            columns = [[r[k] for r, _, _ in found] for k in range(5)] + [[i for _, i, _ in found], [j for _, _, j in found]]
            kinds = [pa.int64()] * 3 + [pa.int32()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*KIND, "from", "to"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*KIND, "times", "bytes"]), strict=True):
                if row[:5] == last[:5]:
                    continue
                if size > _ORDER_BYTES and row[0] != last[0]:
                    yield done()
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[6]), row
        if rows:
            yield done()

    return run


# -- shards ---------------------------------------------------------------------------
def _cut(n: int):
    schema = pa.schema([(c, pa.int64()) for c in KIND[:3]] + [(c, pa.int32()) for c in KIND[3:]]
                       + [("times", pa.int64()), ("contents", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode()
                wanted = batch.column("wanted")[i].as_py()
                yield pa.RecordBatch.from_pylist(
                    [{**p, "bytes": text[p["start"]: p["start"] + p["n_windows"] + n - 1]} for p in wanted], schema)

    return run


def _narrower(n: int, width: int):
    """Each passage in parts, by the place of its windows before the trigger: ``width`` places a part.
    A part is filed under the bytes that all windows at these places share."""
    schema = pa.schema([(f"of_{c}", pa.int64()) for c in KIND[:3]] + [("of_n_windows", pa.int32()), ("of_lead", pa.int32()), ("offset", pa.int32())]
                       + [(c, pa.int64()) for c in KIND[:3]] + [("n_windows", pa.int32()), ("lead", pa.int32()), ("times", pa.int64()), ("bytes", pa.binary())])

    def number(data: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                for part in range((p["lead"] - p["n_windows"] + 1) // width, p["lead"] // width + 1):
                    i = max(0, p["lead"] - (part + 1) * width + 1)
                    j = min(p["n_windows"], p["lead"] - part * width + 1)
                    piece = p["bytes"][i: j - 1 + n]
                    shared = p["bytes"][p["lead"] - part * width: p["lead"] - (part + 1) * width + 1 + n]
                    whole = hashlib.blake2b(piece, digest_size=16).digest()
                    out.append({
                        **{f"of_{c}": p[c] for c in KIND}, "offset": i, "key": number(b"%d:" % part + shared),
                        "c1": int.from_bytes(whole[:8], "little", signed=True), "c2": int.from_bytes(whole[8:], "little", signed=True),
                        "n_windows": j - i, "lead": p["lead"] - i, "times": p["times"], "bytes": piece,
                    })
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


_LONGS = ", ".join(f"{c} long" for c in KIND[:3])
_RUNS = f"{_LONGS}, n_windows int, lead int, `from` int, `to` int"
_PIECES = (", ".join(f"of_{c} long" for c in KIND[:3]) + f", of_n_windows int, of_lead int, offset int, {_LONGS}, n_windows int, lead int, "
           "times long, bytes binary")


def _whole(kinds: DataFrame) -> DataFrame:
    return kinds.filter("times > 1").select(*KIND, F.lit(0).alias("from"), F.col("n_windows").alias("to"))


def _shards(cut: DataFrame, n: int, group: int, width: int) -> DataFrame:
    """Runs of repeated windows of passages (KIND, times, contents, bytes) that are filed with others.
    ``width``: places before the trigger that the windows of a passage can have."""
    if width == 1:  # equal windows are one passage, so there is no shard of more
        return cut.filter("false").select(*KIND, F.lit(0).alias("from"), F.lit(0).alias("to"))
    runs = (
        cut.filter(F.col("contents") <= group).repartition("key").sortWithinPartitions(*KIND)
        .mapInArrow(_ordered(n), _RUNS)
    )
    large = cut.filter(F.col("contents") > group)
    if large.isEmpty():
        return runs
    narrow = -(-width // PARTS)
    pieces = materialise(large.mapInArrow(_narrower(n, narrow), _PIECES), "narrower-passages")
    kinds = materialise(pieces.groupBy(*KIND).agg(F.sum("times").alias("times"), F.first("bytes").alias("bytes")), "narrower-kinds")
    mixed = materialise(kinds.groupBy("key").agg(F.count("*").alias("contents")).filter("contents > 1"), "narrower-shards")
    again = materialise(kinds.join(mixed, "key"), "narrower-shared")
    found = materialise(_whole(kinds).unionByName(_shards(again, n, group, narrow)), "narrower-runs")
    back = pieces.drop("bytes", "times").join(found, KIND).select(
        *[F.col(f"of_{c}").alias(c) for c in KIND], (F.col("from") + F.col("offset")).alias("from"), (F.col("to") + F.col("offset")).alias("to"))
    return runs.unionByName(back)


def repeated_windows(documents: DataFrame, n: int, group: int = GROUP, trigger: int = TRIGGER, span: int = SPAN) -> DataFrame:
    """(doc_id, h, from, to): places of a text, to excluded, whose windows occur again; runs may overlap.

    ``documents`` has doc_id, h, text; h tells texts of one id apart.
    """
    if trigger + span > n or span < 2:
        raise ValueError("a window must hold a trigger at any of its places")
    passages = materialise(documents.mapInArrow(
        _passages(n, trigger, span), f"doc_id long, h long, start int, {_LONGS}, n_windows int, lead int"), "byte-passages", "zstd")
    often = materialise(passages.groupBy("key").count().filter("count > 1").select("key"), "byte-keys")
    shared = materialise(passages.join(often, "key", "left_semi"), "byte-shared", "zstd")
    kinds = materialise(shared.groupBy(*KIND).agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "h", "start")).alias("at")), "byte-kinds", "zstd")
    mixed = materialise(kinds.groupBy("key").agg(F.count("*").alias("contents")).filter("contents > 1"), "byte-shards")
    wanted = kinds.join(mixed, "key").groupBy("at.doc_id", "at.h").agg(F.collect_list(
        F.struct(*KIND, "times", "contents", "at.start")).alias("wanted"))
    texts = documents.alias("d").join(
        wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h")))
    cut = materialise(texts.select("text", "wanted").mapInArrow(
        _cut(n), f"{_LONGS}, n_windows int, lead int, times long, contents long, bytes binary"), "byte-cut", "zstd")
    runs = materialise(_whole(kinds).unionByName(_shards(cut, n, group, span)), "byte-runs", "zstd")
    return shared.join(runs, KIND).select(
        "doc_id", "h", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))


def _remove(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            texts = batch.column("text").cast(pa.large_binary())
            for text, spans in zip(texts, batch.column("spans"), strict=True):
                data, kept, gone, removed, n_spans = text.as_py() or b"", [], 0, 0, 0
                if spans.is_valid and len(spans):
                    begin = spans.values.field("from").to_numpy()
                    by = np.argsort(begin, kind="stable")
                    begin, end = begin[by], np.maximum.accumulate(spans.values.field("to").to_numpy()[by].astype(np.int64) + n - 1)
                    fresh = np.concatenate(([True], begin[1:] > end[:-1]))
                    last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(by) - 1]))
                    for i, j in zip(begin[fresh].tolist(), end[last].tolist(), strict=True):
                        kept.append(data[gone:i])
                        gone, removed, n_spans = j, removed + j - i, n_spans + 1
                kept.append(data[gone:])
                rest = b"".join(kept)
                for column, value in zip(columns, (len(data), removed, n_spans, rest, hashlib.sha256(rest).hexdigest()), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run


def remove_repeats(documents: DataFrame, n: int = 200, group: int = GROUP, trigger: int = TRIGGER, span: int = SPAN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256): one row per document; kept is binary, as cuts may part a character."""
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    spans = repeated_windows(base, n, group, trigger, span).groupBy("doc_id", "h").agg(
        F.collect_set(F.struct("from", "to")).alias("spans"))  # copies of a row have the same ones
    joined = base.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.h") == F.col("s.h")), "left")
    return joined.select("d.doc_id", "text", "spans").mapInArrow(
        _remove(n), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
