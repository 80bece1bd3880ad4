"""Words of texts as arrays of 64-bit hashes, for many texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, as ``bytes.split`` has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes; a longer text is a range of its own."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def batch_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with their texts in UTF-8; null is an empty text."""
    texts = batch.column(column)
    for i, j in chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        part = batch.slice(i, j - i)
        yield part, [x or b"" for x in texts.slice(i, j - i).cast(pa.large_binary()).to_pylist()]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte of each word, byte after each word)."""
    a = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([True], _SPACE[a], [True])).astype(np.int8))
    return a, np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the number of words last)."""
    a, begin, end = word_spans(b"\n".join(texts))
    place = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=place[1:])
    first = np.searchsorted(begin, place)
    if not len(begin):
        return np.zeros(0, np.uint64), first
    size = end - begin
    scale = powers(int(size.max()))
    out = np.empty(len(begin), np.uint64)
    for i, j in chunks(size.tolist()):  # a word longer than the limit is worked on alone
        n = size[i:j]
        from_ = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(from_, n)
        letters = a[np.repeat(begin[i:j], n) + within].astype(np.uint64) + np.uint64(1)
        out[i:j] = np.add.reduceat(letters * scale[within], from_)
    return mix(out ^ (size.astype(np.uint64) << np.uint64(56))), first


def gram_hashes(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Hash of the n words from each position on; as long as ``words``, the last n - 1 have no meaning."""
    out, done = np.zeros_like(words), 0
    run, span, step = words.copy(), 1, base
    with np.errstate(over="ignore"):
        scale = np.uint64(1)
        while True:
            if n & span:
                out[: len(words) - done] += scale * run[done:] if done < len(words) else 0
                scale, done = scale * step, done + span
            if span * 2 > n:
                return mix(out)
            longer = run.copy()
            longer[: max(len(run) - span, 0)] += step * run[span:]
            run, span, step = longer, span * 2, step * step
