"""Centroid clustering, spelling variants and byte repeats against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from sightline.llm import byte_repeats, catalogue, pivot_clusters, spelling

DOCUMENTS = "doc_id long, text string, h string, word string, key string"
VECTORS = "vec_id long, embedding array<float>, cluster string, x string"


@pytest.fixture
def documents(spark):
    return lambda rows: spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], DOCUMENTS)


# -- clustering ------------------------------------------------------------------------
def some_vectors(seed: int, n: int = 400, size: int = 64) -> list:
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, size))
    rows = [(i, (centres[r.integers(12)] * 0.3 + r.normal(size=size) * 0.1).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, rows[0][1]), (n, rows[0][1]), (None, rows[1][1])]  # equal vectors, a repeated row, no id
    rows += [(n + 1, None), (n + 2, []), (n + 3, [0.5] * 63), (n + 4, [float("nan")] + [0.0] * 63), (n + 5, [float("inf")] * 64),
             (n + 6, [None] + [0.0] * 63), (n + 7, [0.0] * 64), (n + 8, [-0.001] * 64)]
    return rows


def clusters_by_hand(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))[::-1]

    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[nearest(v)[0]].append(v)
        for c, members in of.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, c, d in last:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for i, c, d in last]


@pytest.mark.parametrize("n", [400, 9])
def test_clusters(spark, n):
    rows = some_vectors(n, n)
    frame = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], VECTORS)
    got = [tuple(r) for r in pivot_clusters.cluster_vectors(frame).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(repr, got), key=key) == sorted(map(repr, clusters_by_hand(rows)), key=key)


def test_clusters_of_nothing_of_equals_and_of_huge_values(spark):
    none = pivot_clusters.cluster_vectors(spark.createDataFrame([(1, None, "", "")], VECTORS))
    assert none.collect() == [] and none.columns[0] == "vec_id"
    same = spark.createDataFrame([(i, [0.25] * 64, "", "") for i in range(50)], VECTORS)
    assert {(r["cluster"], r["distance"]) for r in pivot_clusters.cluster_vectors(same).collect()} == {(0, 0)}
    huge = spark.createDataFrame([(i, [(-1.0) ** i * 3e38] * 64, "", "") for i in range(6)], VECTORS)
    assert len(pivot_clusters.cluster_vectors(huge, k=2).collect()) == 6


def test_bounds_never_exceed_distances_and_leave_centroids_out():
    r = np.random.default_rng(1)
    x = np.concatenate([r.integers(-300, 300, (300, 8)), r.integers(-1 << 27, 1 << 27, (300, 8))])
    centroids = x[::30].copy()
    pivots = pivot_clusters.choose_pivots(centroids, 5)
    nearest = pivot_clusters.Nearest(centroids, pivots)
    exact = pivot_clusters.squares(x, centroids)
    to_pivots = pivot_clusters.squares(x, pivots)
    assert (nearest.bounds(to_pivots) <= exact).all()
    cluster, distance, worked_out = nearest.assign(x, to_pivots)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert worked_out < 0.8 * exact.size


def test_clusters_match_their_sql(spark):
    import __spark_entry__ as registered

    path = "/root/testdata/sf0.001"
    got = registered.queries()["op11_pivot_clusters"](spark, path)
    duck = duckdb.connect()
    duck.sql(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    want = duck.sql(catalogue.ORACLES["op11_pivot_clusters"])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.select(*names).fetchall())


# -- spelling --------------------------------------------------------------------------
def near_by_hand(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(rows, least=5, times=3, one_in=97, factor=2):
    import re

    total = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                total[w] += 1
    n = {w: c for w, c in total.items() if c >= times}
    near = {w: [v for v in n if near_by_hand(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def some_words(seed: int) -> list:
    r = random.Random(seed)
    letters = "abcdeéß×Ä"
    stems = ["".join(r.choices(letters, k=r.randint(4, 9))) for _ in range(25)] + ["a" * 5000, "strasse"]
    rows = [(1, None), (2, ""), (3, " 12 .,"), (None, "strasse Strasse STRASSE strassé")]
    for i in range(150):
        words = []
        for _ in range(60):
            w = r.choices(stems, [1 / (k + 1) for k in range(len(stems))])[0]
            if len(w) < 100 and r.random() < 0.4:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1:]])
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i + 10, r.choice(" 1-").join(words)))
    return [*rows, rows[-1]]


@pytest.mark.parametrize(("piece", "one_in"), [(1024, 97), (3, 5)])
def test_variants(documents, piece, one_in):
    rows = some_words(piece)
    want = variants_by_hand(rows, one_in=one_in)
    got = [tuple(r) for r in spelling.variants(documents(rows), one_in=one_in, piece=piece).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(w[3] is not None and w[5] != w[3] for w in want) or piece == 1024


def test_no_variants(documents):
    assert spelling.variants(documents([])).collect() == []
    assert spelling.variants(documents([(1, None), (2, "unique words only here")])).collect() == []


def test_roots_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w37"}


# -- byte repeats -----------------------------------------------------------------------
def repeats_by_hand(rows, n):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i: i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for at in range(len(d) - n + 1):
            if seen[d[at: at + n]] > 1:
                gone[at: at + n] = b"\1" * n
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for at, g in enumerate(gone) if g and not (at and gone[at - 1]))
        out.append((i, len(d), sum(gone), spans, kept, hashlib.sha256(kept).hexdigest()))
    return out


def some_bytes(seed: int, n: int) -> list:
    """Copies, edited copies, one passage in many contexts, runs of one letter, zero bytes, short texts."""
    r = random.Random(seed)
    word = [f"w{i}" for i in range(300)] + ["Ärger", "a b", "日本", "\0", "#"]
    text = lambda k: " ".join(r.choices(word, k=k))
    passage = text(n // 2)
    rows = [(1, None), (2, ""), (3, "x"), (4, "é" * (2 * n)), (5, "ab" * n), (6, "ab" * (n // 2)), (None, text(n)), (None, passage)]
    while len(rows) < 60:
        kind, old = r.random(), r.choice([t for _, t in rows if t])
        if kind < 0.15:
            new = old
        elif kind < 0.5:
            at = r.randrange(len(old))
            new = old[:at] + r.choice(["", "x", " changed "]) + old[at + r.randint(0, 3):]
        elif kind < 0.8:
            new = text(r.randint(0, 30)) + passage[r.randint(0, 9):] + text(r.randint(0, 30))
        else:
            new = text(r.randint(1, n))
        rows.append((10 + 3 * len(rows), new))
    return [*rows, rows[-1], rows[-1], rows[12]]


@pytest.mark.parametrize(("n", "group", "trigger", "span"), [(200, 2000, 24, 144), (40, 3, 6, 30), (24, 1, 5, 17)])
def test_byte_repeats(documents, n, group, trigger, span):
    rows = some_bytes(n, n)
    want = repeats_by_hand(rows, n)
    got = [tuple(r) for r in byte_repeats.remove_repeats(documents(rows), n, group, trigger, span).collect()]
    assert sorted(((*g[:4], bytes(g[4]), g[5]) for g in got), key=repr) == sorted(want, key=repr)
    assert any(w[2] and w[2] < w[1] for w in want)


def test_byte_repeats_of_no_rows_and_of_a_text_in_pieces(spark, documents, monkeypatch):
    assert byte_repeats.remove_repeats(documents([])).collect() == []
    r = random.Random(5)
    long = "".join(r.choices("abcdefgh ", k=9000))
    texts = [long + long[2000:2600], "".join(r.choices("xyz", k=400)) + long[4100:4500]]
    import pyarrow as pa

    monkeypatch.setattr(byte_repeats, "CHUNK_BYTES", 1000)
    whole = []
    for rows, offsets, parts in byte_repeats._segments(pa.array([t.encode() for t in texts], pa.large_binary()), 200):
        whole += [(int(i), int(o) + k, p[k: k + 200]) for i, o, p in zip(rows, offsets, parts) for k in range(len(p) - 199)]
    assert sorted(whole) == [(i, k, t.encode()[k: k + 200]) for i, t in enumerate(texts) for k in range(len(t) - 199)]


def test_suffix_order_by_prefix_free_parsing():
    r = random.Random(2)
    texts = [bytes(r.choices(b"ab\0\xff", k=r.randint(1, 90))) for _ in range(30)] + [b"a" * 80, b"ab" * 40, b"a" * 80]
    parse = byte_repeats.PrefixFreeParse(texts, w=3, one_in=4)
    places = np.concatenate([parse.first[i] + np.arange(len(t)) for i, t in enumerate(texts)])
    suffix = {int(parse.first[i]) + k: t[k:] for i, t in enumerate(texts) for k in range(len(t))}
    got = [suffix[int(p)] for p in parse.order(places)[0]]
    assert got == sorted(suffix.values())
    for n in (1, 5, 30):
        wide = [p for p in places.tolist() if len(suffix[p]) >= n]
        seen = Counter(suffix[p][:n] for p in wide)
        assert sorted(parse.repeated(np.array(wide), n).tolist()) == [p for p in wide if seen[suffix[p][:n]] > 1]
