"""Removal of word sequences that repeat across a corpus, with suffix automata.

A window is ``n`` consecutive words of one document. Every word that a repeated
window covers is removed, in each of its places.

The reference is the corpus itself, so its automata have no size bound and are not
broadcast to every executor. Each one is sent, by the shuffle, to the task that
streams the passages which can match it:

1. Every window is filed under its anchor, the leftmost of its ``k``-word grams with
   the smallest hash. Equal windows have equal anchors. Consecutive windows with one
   anchor make a passage of at most 2n - k words, known by a hash of its words.
2. Anchors met once in the corpus cannot hold a repeated window and go.
3. The different passages of an anchor, each with the number of times it stands for, form
   a reference shard. Its suffix automaton is built, with the number of times each state
   occurs, and the shard's passages are streamed through it: the state of the last ``n``
   words tells whether they occur again.
4. A shard over ``GROUP`` different passages (a phrase with an endless number of
   contexts) would make an unbounded automaton. It is cut into several by the place of the
   windows before the anchor: windows of a narrower range share more words, so their parts
   are filed under longer strings, in smaller shards, each with its automaton. In the end a
   shard has one window. No case is dropped.
5. The repeated windows return to their documents, whose remaining words are joined.

Null, empty or short texts have no window and lose nothing. Repeated rows, also with
one id, are documents of their own: everything in them repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.words import batch_chunks, gram_hashes, hash_words, mix
from sightline.session import materialise

ANCHOR_WORDS = 12
GROUP = 1000
PARTS = 4
KIND = ["anchor", "content", "n_windows", "lead"]
_A, _B = np.uint64(0xD1342543DE82EF95), np.uint64(0xF1357AEA2E62A9C5)
_KINDS = "anchor long, content long, n_windows int, lead int"


class SuffixAutomaton:
    """Of several word sequences, each with a number of times it stands for."""

    def __init__(self) -> None:
        self.step: list[dict] = [{}]
        self.link, self.length, self.seen = [-1], [0], [0]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        self.seen.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = twin
            p = self.link[p]
        return twin

    def add(self, words: Iterable, times: int) -> None:
        last = 0
        for word in words:
            q = self.step[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                new, p = self._state(self.length[last] + 1, {}, 0), last
                while p >= 0 and word not in self.step[p]:
                    self.step[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.step[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                last = new
            self.seen[last] += times

    def count(self) -> None:
        """After the last ``add``: each state gets the number of places where it occurs."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.seen[self.link[s]] += self.seen[s]

    def matches(self, words: Iterable, most: int) -> Iterator[tuple[int, int]]:
        """For each word: length of the longest match that ends there, ``most`` at most, and its occurrences."""
        state = length = 0
        for word in words:
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                length += 1
            while length > most and self.length[self.link[state]] >= most:
                state = self.link[state]
                length = self.length[state]
            if length > most:
                length = most
            yield length, self.seen[state]


def _passages(n: int, k: int):
    width = n - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batch_chunks(batch):
                words, first = hash_words(texts)
                if len(words) < n:
                    continue
                grams = gram_hashes(words, k, _A)
                windows = gram_hashes(words, n, _B)
                low = np.arange(len(words))
                span = 1
                while span < width:  # leftmost smallest gram of ``width`` from each place on
                    by = min(span, width - span)
                    right = low[by:]
                    left = low[: len(right)]
                    low = np.concatenate((np.where(grams[left] <= grams[right], left, right), low[len(right):]))
                    span += by
                document = np.repeat(np.arange(len(texts)), np.diff(first))
                place = np.arange(len(words)) - first[document]
                at = np.flatnonzero(place + n <= np.diff(first)[document])
                if not len(at):
                    continue
                fresh = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(low[at]) != 0)))
                begin = at[fresh]
                end = at[np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(at) - 1]))]
                more = (end - begin).astype(np.uint64)
                content = mix(windows[begin] ^ mix(windows[end] + more))
                row = document[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row)), part.column("h").take(pa.array(row)),
                        pa.array(place[begin].astype(np.int32)), pa.array((end - begin + 1).astype(np.int32)),
                        pa.array((low[begin] - begin).astype(np.int32)),
                        pa.array(grams[low[begin]].view(np.int64)), pa.array(content.view(np.int64)),
                    ],
                    ["doc_id", "h", "start", "n_windows", "lead", "anchor", "content"],
                )

    return run


def _cut(n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, wanted in zip(frame["text"], frame["wanted"], strict=True):
                words = text.encode().split()
                yield pd.DataFrame(
                    [(*(w[k] for k in KIND), w["times"], w["contents"],
                      b" ".join(words[w["start"]: w["start"] + w["n_windows"] + n - 1]).decode()) for w in wanted],
                    columns=[*KIND, "times", "contents", "words"],
                )

    return run


def _shard(n: int, passages: dict[tuple, tuple[list, int]]) -> Iterator[tuple]:
    """(kind, bits of its repeated windows) of the passages of one shard."""
    automaton = SuffixAutomaton()
    for words, times in passages.values():
        automaton.add(words, times)
    automaton.count()
    for kind, (words, _) in passages.items():
        bits = 0
        for i, (length, seen) in enumerate(automaton.matches(words, n)):
            if length >= n and seen > 1:
                bits |= 1 << (i - n + 1)
        yield (*kind, bits)


def _shards(n: int):
    """Rows come sorted by anchor; a shard may go on in the next batch and has at most ``GROUP`` passages."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchor, passages = None, {}

        def done():
            return [r for r in _shard(n, passages) if r[-1]] if passages else []

        for frame in frames:
            found = []
            kinds = zip(*(frame[k] for k in KIND), strict=True)
            for kind, words, times in zip(kinds, frame["words"], frame["times"], strict=True):
                if kind[0] != anchor:
                    found += done()
                    anchor, passages = kind[0], {}
                passages.setdefault(kind, (words.split(" "), times))
            yield pd.DataFrame(found, columns=[*KIND, "bits"])
        yield pd.DataFrame(done(), columns=[*KIND, "bits"])

    return run


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _narrower(n: int, width: int):
    """Each passage in parts, by the place of its windows before the anchor: ``width`` places a part.
    A part is filed under the words that all windows at these places share."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            kinds = zip(*(frame[k] for k in KIND), strict=True)
            for kind, joined, times in zip(kinds, frame["words"], frame["times"], strict=True):
                words, (_, _, n_windows, lead) = joined.split(" "), kind
                for part in range((lead - n_windows + 1) // width, lead // width + 1):
                    i, j = max(0, lead - (part + 1) * width + 1), min(n_windows, lead - part * width + 1)
                    piece = " ".join(words[i: j - 1 + n])
                    shared = " ".join(words[lead - part * width: lead - (part + 1) * width + 1 + n])
                    out.append((*kind, i, _number(f"{part}:{shared}"), _number(piece), j - i, lead - i, times, piece))
            yield pd.DataFrame(out, columns=[*(f"of_{k}" for k in KIND), "offset", *KIND, "times", "words"])

    return run


def _marks(cut: DataFrame, n: int, group: int, width: int) -> DataFrame:
    """(kind, bits) of the passages (kind, times, contents, words) with repeated windows; ``width``: places
    before the anchor that the windows of a passage can have."""
    by_automaton = (
        cut.filter((F.col("contents") <= group) | F.lit(width == 1)).repartition("anchor").sortWithinPartitions(*KIND)
        .mapInPandas(_shards(n), f"{_KINDS}, bits long")
    )
    large = cut.filter((F.col("contents") > group) & F.lit(width > 1))
    if large.isEmpty():
        return by_automaton
    narrow = -(-width // PARTS)
    of = ", ".join(f"of_{k}" for k in _KINDS.split(", "))
    pieces = materialise(large.mapInPandas(
        _narrower(n, narrow), f"{of}, offset int, {_KINDS}, times long, words string"), "narrower-passages")
    kinds = materialise(pieces.groupBy(*KIND).agg(F.sum("times").alias("times"), F.first("words").alias("words")), "narrower-kinds")
    met = materialise(kinds.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum("times").alias("all")).filter(
        F.col("all") > 1).drop("all"), "narrower-shards")
    found = materialise(_marks(materialise(kinds.join(met, "anchor"), "narrower-shared"), n, group, narrow), "narrower-marks")
    back = pieces.drop("words", "times").join(found, KIND).select(
        *[F.col(f"of_{k}").alias(k) for k in KIND], F.expr("shiftleft(bits, offset)").alias("bits"))
    return by_automaton.unionByName(back.groupBy(*KIND).agg(F.bit_or("bits").alias("bits")))


def repeated_passages(documents: DataFrame, n: int, k: int = ANCHOR_WORDS, group: int = GROUP) -> DataFrame:
    """(doc_id, h, start, bits): bit i is set where the window at word start + i occurs again.

    ``documents`` has doc_id, h, text; h tells texts of one id apart.
    """
    if not 0 < n - k < 62 or n - k >= n:
        raise ValueError("the anchor must be shorter than the window, by 61 words at most")
    passages = materialise(documents.mapInArrow(
        _passages(n, k), "doc_id long, h long, start int, n_windows int, lead int, anchor long, content long"), "passages")
    # written, so that a frequent anchor's rows can be split in the join
    often = materialise(passages.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    shared = materialise(passages.join(often, "anchor", "left_semi"), "shared-passages")
    kinds = materialise(shared.groupBy(*KIND).agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "h", "start")).alias("at")), "passage-kinds")
    shards = materialise(kinds.groupBy("anchor").agg(F.count("*").alias("contents")), "passage-shards")

    wanted = kinds.join(shards, "anchor").groupBy("at.doc_id", "at.h").agg(F.collect_list(
        F.struct(*KIND, "times", "contents", "at.start")).alias("wanted"))
    texts = documents.alias("d").join(
        wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h")))
    cut = materialise(texts.select("text", "wanted").mapInPandas(
        _cut(n), f"{_KINDS}, times long, contents long, words string"), "passage-words", "zstd")
    marks = materialise(_marks(cut, n, group, n - k + 1), "passage-marks")
    return shared.join(marks, KIND).select("doc_id", "h", "start", "bits")


def _remove(n: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept_text, digest = [], [], [], []
            texts = batch.column("text").cast(pa.large_binary())
            for text, spans in zip(texts, batch.column("spans"), strict=True):
                words = (text.as_py() or b"").split()
                if spans.is_valid and len(spans):
                    edge = np.zeros(len(words) + 1, np.int64)
                    start = spans.values.field("start").to_numpy()
                    bits = spans.values.field("bits").to_numpy()
                    for i in range(width):
                        at = start[(bits >> i) & 1 == 1] + i
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + n, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                    n_removed.append(int(gone.sum()))
                else:
                    kept = b" ".join(words)
                    n_removed.append(0)
                n_words.append(len(words))
                kept_text.append(kept)
                digest.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept_text, pa.binary()).cast(pa.string()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return run


def remove_repeats(documents: DataFrame, n: int = 35, k: int = ANCHOR_WORDS, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256): one row per document, other columns are left out."""
    base = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    spans = repeated_passages(base, n, k, group).groupBy("doc_id", "h").agg(
        F.collect_set(F.struct("start", "bits")).alias("spans"))  # copies of a row have the same ones
    joined = base.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.h") == F.col("s.h")), "left")
    return joined.select("d.doc_id", "text", "spans").mapInArrow(
        _remove(n, n - k + 1), "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
