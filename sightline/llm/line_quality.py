"""Document quality from a linear-chain CRF that labels every line good or bad.

A line's features are shares and ratios of its characters and words, with the same of
the lines before and after it; nothing of them depends on language, source or id. The
chain's transition weights let neighbours agree. The score of a document is the mean of
its lines' forward-backward marginals of "good", weighted by length, put through a
logistic curve that is fitted with the weights.

Training takes labelled documents, each line with its document's label, from at most
``TRAIN_ROWS`` documents in order of a hash of their id. That is the only bound: all lines
of these documents teach, in chains of at most ``CHAIN`` lines, and every line of every
document is scored. The model is some hundred numbers and goes to the tasks with the code.

Null, empty and blank texts have one empty line. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sightline.llm.words import batch_chunks, chunks, hash_words, mix, word_spans

TRAIN_ROWS = 4000
CHAIN = 64
_CELLS = 30_000  # lines of a group of chains, filled up
_STEPS = 120
_GROUP = 256
_FEATURES = 52  # 17 of the line, of the one before and of the one after, and a constant
_UPPER, _LETTER, _DIGIT, _BLANK, _BAR, _MARK = range(6)
_KINDS = np.zeros((6, 256), bool)
_KINDS[_UPPER, 65:91] = True
_KINDS[_LETTER, 65:91] = _KINDS[_LETTER, 97:123] = _KINDS[_LETTER, 128:] = True
_KINDS[_DIGIT, 48:58] = True
_KINDS[_BLANK, [9, 11, 12, 13, 32]] = True
_KINDS[_BAR, 124] = True
_KINDS[_MARK, [ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line with those of its neighbours, its bytes, first line of every text and the number last)."""
    data = b"\n".join(texts)
    a, word, word_end = word_spans(data)
    ends = np.append(np.flatnonzero(a == 10), len(a))
    begins = np.concatenate(([0], ends[:-1] + 1))
    first = np.concatenate(([0], np.cumsum([t.count(b"\n") + 1 for t in texts])))
    document = np.repeat(np.arange(len(texts)), np.diff(first))
    n, lines = ends - begins, len(begins)

    def share(kind: int) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(_KINDS[kind][a])))
        return (upto[ends] - upto[begins]) / np.maximum(n, 1)

    at = np.searchsorted(begins, word, "right") - 1
    k = np.bincount(at, minlength=lines)
    some = np.maximum(k, 1)
    hashes, _ = hash_words([data])
    odd = np.bincount(at[_KINDS[_MARK][a[word_end - 1]]], minlength=lines) / some if len(word) else np.zeros(lines)
    twice = np.zeros(lines)
    same, unlike, last = np.zeros(lines), np.zeros(lines), np.zeros(lines)
    line_hash = np.zeros(lines, np.uint64)
    if len(word):
        np.add.at(twice, at[1:], (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1]))
        order = np.lexsort((hashes, at))
        run = np.flatnonzero(np.concatenate(([True], (np.diff(at[order]) != 0) | (np.diff(hashes[order]) != 0))))
        length, owner = np.diff(np.append(run, len(order))), at[order][run]
        np.maximum.at(same, owner, length)
        unlike = np.bincount(owner, minlength=lines).astype(float)
        full = np.flatnonzero(k)
        head = np.cumsum(k) - k
        place = np.arange(len(word)) - head[at]
        line_hash[full] = np.add.reduceat(mix(hashes + place.astype(np.uint64)), head[full])
        last[full] = np.isin(a[word_end[head[full] + k[full] - 1] - 1], [33, 46, 63])
    size = (n * (1 - share(_BLANK))) / some
    again, before = np.zeros(lines), np.zeros(lines)
    order = np.lexsort((np.arange(lines), line_hash, document))
    equal = (np.diff(document[order]) == 0) & (line_hash[order][1:] == line_hash[order][:-1]) & (k[order][1:] > 0)
    again[order[1:][equal]] = 1
    before[1:] = (np.diff(document) == 0) & (line_hash[1:] == line_hash[:-1]) & (k[1:] > 0)
    x = np.stack([
        k == 0, np.minimum(np.log1p(k) / 6, 1.5), np.minimum(size / 10, 3), np.abs(np.minimum(size, 30) - 5.5) / 10,
        share(_LETTER), share(_BLANK), np.where(k > 3, 1, 0.5) * share(_UPPER), share(_DIGIT), share(_BAR) * 5, share(_MARK) * 5,
        odd, np.where(k > 2, same / some, 0), twice / some, unlike / some, last, again, before], axis=1).astype(float)
    ahead, behind = np.zeros_like(x), np.zeros_like(x)
    inside = np.diff(document) == 0
    ahead[1:][inside], behind[:-1][inside] = x[:-1][inside], x[1:][inside]
    return np.concatenate((x, ahead, behind, np.ones((lines, 1))), axis=1), np.maximum(n, 1).astype(float), first


@dataclass
class LineModel:
    weights: np.ndarray  # of each feature, for "good" against "bad"
    bonds: np.ndarray  # of two neighbours' labels
    slope: float
    base: float

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """Mean marginal of "good" of each text's lines, by length."""
        x, size, first = line_features(texts)
        own, n = _potentials(x, self.weights), np.diff(first)
        out = np.empty(len(texts))
        order = np.argsort(n, kind="stable")
        for i in range(0, len(order), _GROUP):
            part = order[i: i + _GROUP]
            for half in (part[n[part] <= 4 * n[part[0]]], part[n[part] > 4 * n[part[0]]]):
                if not len(half):
                    continue
                at = first[half][:, None] + np.arange(n[half].max())
                mask = np.arange(n[half].max()) < n[half][:, None]
                at = np.minimum(at, len(x) - 1)
                good = _batch_pass(own[at], mask, self.bonds)[0][..., 1]
                weight = size[at] * mask
                out[half] = (good * weight).sum(1) / weight.sum(1)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.shares(texts) + self.base, -30, 30)))


def _potentials(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    score = x @ weights / 2
    return np.stack((-score, score), axis=-1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _batch_pass(own: np.ndarray, mask: np.ndarray, bonds: np.ndarray, weight: np.ndarray | None = None):
    """Forward-backward over many chains (chain, line, label), filled up to one length.

    Marginals of the labels and, with a ``weight`` for each chain, expected counts of label pairs.
    """
    n = own.shape[1]
    ahead, back = np.empty_like(own), np.zeros_like(own)
    ahead[:, 0] = own[:, 0]
    for i in range(1, n):
        step = own[:, i] + _logsum(ahead[:, i - 1, :, None] + bonds, 1)
        ahead[:, i] = np.where(mask[:, i, None], step, ahead[:, i - 1])
    for i in range(n - 2, -1, -1):
        step = _logsum(bonds + (own[:, i + 1] + back[:, i + 1])[:, None, :], 2)
        back[:, i] = np.where(mask[:, i + 1, None], step, back[:, i + 1])
    total = _logsum(ahead[:, -1], 1)
    if weight is None:
        return np.exp(ahead + back - total[:, None, None]), None
    pairs = np.exp(ahead[:, :-1, :, None] + bonds + (own[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None])
    return np.exp(ahead + back - total[:, None, None]), (pairs * (mask[:, 1:] * weight[:, None])[:, :, None, None]).sum((0, 1))


def fit(texts: list[bytes], labels: list[int], lines: int = CHAIN, steps: int = _STEPS) -> LineModel:
    """Maximum likelihood with a small penalty, by Adam, over chains sorted into groups of like length.

    A text of more than ``lines`` lines makes several chains, which share its weight. Classes weigh the same. Without both labels the model is even: every score is the share of label 1.
    """
    y = np.array(labels, float)
    data, width = [], _FEATURES
    for i, j in chunks([len(t) for t in texts]):
        x, _, first = line_features(texts[i:j])
        data += [x[p:q] for p, q in zip(first[:-1], first[1:], strict=True)]
    if not 0 < y.sum() < len(y):
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return LineModel(np.zeros(width), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    chains = sorted(((i, at) for i, own in enumerate(data) for at in range(0, len(own), lines)),
                    key=lambda c: min(lines, len(data[c[0]]) - c[1]))
    groups, per_group = [], max(1, _CELLS // lines)
    for first in range(0, len(chains), per_group):
        part = chains[first: first + per_group]
        n = min(lines, len(data[part[-1][0]]) - part[-1][1])
        x, mask = np.zeros((len(part), n, width)), np.zeros((len(part), n), bool)
        for r, (i, at) in enumerate(part):
            own = data[i][at: at + n]
            x[r, : len(own)], mask[r, : len(own)] = own, True
        of = np.array([i for i, _ in part])
        groups.append((x, mask, y[of], weight[of] / np.array([len(data[i]) for i in of])))
    theta, m, v = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    for step in range(1, steps + 1):
        gradient = -1e-4 * theta
        for x, mask, good, w in groups:
            own = _potentials(x, theta[:width])
            marginal, pairs = _batch_pass(own, mask, theta[width:].reshape(2, 2), w)
            gap = (good[:, None] - marginal[..., 1]) * mask * w[:, None]
            gradient[:width] += np.einsum("rn,rnf->f", gap, x)
            kept = w * (mask.sum(1) - 1)  # neighbours have one label in training
            gradient[width:] -= pairs.ravel()
            gradient[width] += kept[good == 0].sum()
            gradient[width + 3] += kept[good == 1].sum()
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    model = LineModel(theta[:width], theta[width:].reshape(2, 2), 0.0, 0.0)
    shares = np.concatenate([model.shares(texts[i:j]) for i, j in chunks([len(t) for t in texts])])
    a, b = 0.0, float(np.log(y.mean() / (1 - y.mean())))
    for _ in range(50):  # Newton steps of the logistic curve
        p = 1 / (1 + np.exp(-(a * shares + b)))
        z, r = np.stack((shares, np.ones_like(shares))), p * (1 - p)
        a, b = np.array([a, b]) + np.linalg.solve((z * r) @ z.T + 1e-3 * np.eye(2), z @ (y - p) - 1e-3 * np.array([a, b]))
    model.slope, model.base = max(float(a), 1e-3), float(b)
    return model


def held_out() -> Column:
    """The fold that no model learns from; a document without an id is not in it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> LineModel:
    """Model from ``labels`` (doc_id, label 0 or 1) and the texts of these documents; a null label is none."""
    picked = labels.select("doc_id", "label").filter("doc_id is not null and label in (0, 1)").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    told = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "label", "text", "doc_id").orderBy(
        F.xxhash64("doc_id"), "text", "label").limit(rows).collect()
    return fit([(r.text or "").encode() for r in told], [int(r.label) for r in told])


def score(documents: DataFrame, model: LineModel) -> DataFrame:
    """``documents`` with a column score, from 0 to 1, in place of one of that name."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batch_chunks(batch):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(shared.value.scores(texts), pa.float64())], [*part.schema.names, "score"])

    kept = documents.drop("score")
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField("score", DoubleType())]))
