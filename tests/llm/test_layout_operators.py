"""URL rules, packing, vector links, shards, mixing and the pipeline, against brute force and round trips."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from sightline.llm import graph, mixing, ngram_join, packing, shards, tokens, url_rules, vector_links
from sightline.llm.permute import permute

TEXTS = [(1, "The house stands. " * 300), (2, None), (3, ""), (4, "naïve <|endoftext|> ünï  code\n\n x"), (4, "same id"),
         (5, "w " * 2000), (5, "w " * 2000), (None, "no id"), (6, "it's 2024, a\u00a0b \U0001f600")]


@pytest.fixture
def frame(spark):
    rows = [(i, t, ["b", None, "a", ""][n % 4], "clash", 7) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, length string, n_chars int")


def test_encoder_agrees_with_the_tokenizers_library():
    from tokenizers import Tokenizer

    path = tokens.vocabulary_path()
    whole = Tokenizer.from_file(path)
    documents = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    for text in [*(t for _, t in TEXTS), *documents]:
        assert tokens.encoder(path)(text or "").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_packing(frame):
    path = tokens.vocabulary_path()
    ids = [tokens.whole_ids(t, path) for _, t in TEXTS]
    got = packing.pack(frame, path).collect()
    want = Counter((i, len(x), at, min(1024, len(x) - at), zlib.crc32(x[at: at + 1024].tobytes()))
                   for (i, _), x in zip(TEXTS, ids, strict=True) for at in range(0, len(x), 1024))
    assert Counter((r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) <= -(-sum(map(len, ids)) // 1024) + 1
    assert packing.pack(frame.limit(0), path).count() == 0


def test_fullest_multiset_against_all_choices():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 30, 5), rng.integers(1, 4, 5), strict=True)}
        room = int(rng.integers(0, 60))
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        chosen = packing.fullest(counts, room)
        assert all(chosen[n] <= counts[n] for n in chosen)
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)


def test_shards_round_trip(frame):
    path, stride, per_shard = tokens.vocabulary_path(), 16, 32
    table = shards.write_shards(frame, key=5, path=path, stride=stride, per_shard=per_shard)
    rows = shards.ordered(frame, key=5, path=path, stride=stride).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert [r.slot for r in sorted(rows, key=lambda r: (r.doc_id or 0, r.start))] != list(range(len(rows)))
    read = {r.slot: r.ids for r in shards.read_slots(table, 0, len(rows), stride, per_shard).collect()}
    for r in rows:
        own = np.frombuffer(r.ids, "<u2").tolist()
        assert read[r.slot] == own + [0] * (stride - len(own))
    want = Counter(tuple(tokens.whole_ids(t, path).tolist()[at: at + stride]) for _, t in TEXTS
                   for at in range(0, len(tokens.whole_ids(t, path)), stride))
    assert Counter(tuple(np.frombuffer(r.ids, "<u2").tolist()) for r in rows) == want
    assert len(shards.read_slots(table, 40, 70, stride, per_shard).collect()) == 30
    assert [r.n_sequences for r in table.orderBy("shard").collect()][:-1] == [per_shard] * (table.count() - 1)
    assert shards.write_shards(frame.limit(0), path=path).count() == 0
    index = shards.sequences(table).collect()
    own = {r.slot: (r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in rows}
    assert {r.slot: (r.doc_id, r.start, r.length, r.crc32) for r in index} == own and len(index) == len(rows)
    assert all(r.shard == r.slot // per_shard for r in index)


def test_copies_in_many_tasks_have_a_place_each(spark):
    """Copies of one row, with an id and without, also of a text of several blocks, dealt over tasks."""
    long = " ".join(f"w{i}" for i in range(1500))
    rows = [(1, long)] * 5 + [(None, long)] * 4 + [(None, "short")] * 7 + [(2, "short")] * 3 + [(2, "other")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in (1, 4, 9):
        got = shards.ordered(table.repartition(parts), 3, tokens.vocabulary_path(), 16).collect()
        assert sorted(r.slot for r in got) == list(range(len(got)))
        found.append(sorted(map(str, got)))
    assert found[0] == found[1] == found[2]
    each = -(-len(tokens.whole_ids(long, tokens.vocabulary_path())) // 16)
    assert each > 2 * shards.PER_BLOCK and len(got) == 9 * each + 11


def test_ids_are_on_disk_once_when_they_move_to_their_shards(frame, monkeypatch):
    written, gone = [], []
    keep, drop = shards.materialise, shards.discard
    monkeypatch.setattr(shards, "materialise", lambda df, label, *a: written.append(label) or keep(df, label, *a))
    monkeypatch.setattr(shards, "discard", lambda df: gone.append(df.columns) or drop(df))
    rows = shards.ordered(frame, 5, tokens.vocabulary_path(), 16)
    assert written[0] == "sequences" and written[-1] == "numbered-sequences"
    assert gone == [["doc_id", "h", "part", "copy", "start", "ids"]]
    assert rows.count() == shards.sequences(shards.write_shards(frame, None, 5, tokens.vocabulary_path(), 16)).count()


def test_training_order_does_not_depend_on_partitions(frame):
    path, order = tokens.vocabulary_path(), ["slot", "doc_id", "start", "length", "ids"]
    ways = [frame.coalesce(1), frame.repartition(3), frame.orderBy(frame["text"].desc())]
    first, *others = [sorted(map(str, shards.ordered(w, 5, path, 16).select(order).collect())) for w in ways]
    assert all(o == first for o in others)
    assert first != sorted(map(str, shards.ordered(frame, 6, path, 16).select(order).collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_one_to_one(n):
    assert sorted(permute(np.arange(n), n, 9).tolist()) == list(range(n))
    if n > 100:
        assert (permute(np.arange(n), n, 9) != permute(np.arange(n), n, 10)).mean() > 0.9


def test_url_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/", "block"), ("org", "", "block"),
             ("x.org", "/a", "allow"), ("x.org", "/a/b", "block"), ("x.org", "/a/b", "allow"), (None, "/", "block"), ("", "/", "block"),
             ("net", "/e", "allow"), ("k.com", None, "block")]
    hosts = ["example.net", "a.example.net", "b.a.example.net", "notexample.net", "net", "x.org", "y.x.org", "k.com", "K.Com", "com",
             "", ".net", "net.", "example.net:80", "a..net", "ex\u00e4mple.net"]
    urls = [f"https://{h}{p}" for h in hosts for p in ("", "/", "/en/x?q#f", "/a/b", "/a/c", "/e", "?/en/")]
    urls += [None, "", "no scheme.net/", "://", "a://b://net/", "http://net/a/b"]
    pages = spark.createDataFrame([(i // 2, u, "clash") for i, u in enumerate(urls * 2)], "page_id long, url string, host string")
    got = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()

    def judge(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].lower() if rest[:cut].isascii() else rest[:cut], rest[cut:]
        path = rest.split("?")[0].split("#")[0]
        fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules
                if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        return (host, path, *max(fits)[2:]) if fits else (host, path, None, "allow")

    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter(
        (i // 2, *judge(u)) for i, u in enumerate(urls * 2))
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(pages, none, "block").collect()} == {"block"}
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vector_links(spark, kind):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 12))
    x = np.concatenate([c + 0.2 * rng.standard_normal((n, 12)) for c, n in zip(centres, [60, *[3] * 39], strict=True)]).astype("f4")
    rows = [(i * 2, [float(v) for v in row], 0, "clash") for i, row in enumerate(x)]
    odd = [(9001, None), (9002, []), (9003, [0.0] * 12), (9004, [None, *[1.0] * 11]), (9005, [float("nan")] * 12),
           (9006, [float("inf"), *[1.0] * 11]), (None, rows[0][1])]
    rows += [(i, v, 1, "clash") for i, v in odd] + [(7001, rows[5][1], 1, "x"), (7001, rows[5][1], 1, "x")]
    got = vector_links.link_vectors(spark.createDataFrame(
        rows, f"vec_id long, embedding array<{kind}>, label int, component_id string"), block=16).collect()
    assert len(got) == len(rows)
    for i, _ in odd:
        assert next((r.n_links, r.component_id, r.kept) for r in got if r.vec_id == i) == (0, i, i is not None)
    good = [r for r in rows if r[0] is not None and r[0] < 9000]
    m = np.array([r[1] for r in good])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    np.fill_diagonal(near, False)
    links = {r.vec_id: r.n_links for r in got if r.vec_id is not None and r.vec_id < 9000}
    want = {r[0]: int(n) for r, n in zip(good, near.sum(1), strict=True)}
    assert all(links[i] <= want[i] for i in want)
    assert sum(links.values()) >= 0.9 * sum(want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    empty = spark.createDataFrame([], f"vec_id long, embedding array<{kind}>")
    assert vector_links.link_vectors(empty).count() == 0


@pytest.mark.parametrize(("n", "block"), [(2, 1), (5, 1), (10, 1), (5, 4096), (300, 16)])
def test_vector_links_of_one_near_group(spark, n, block):
    rng = np.random.default_rng(n)
    x = rng.standard_normal(16)
    x = x / np.linalg.norm(x) + 0.075 * rng.standard_normal((n, 16))
    got = vector_links.link_vectors(spark.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>"), block=block).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum() - n
    assert want and sum(r.n_links for r in got) >= vector_links.RECALL * want
    assert n > 10 or sum(r.n_links for r in got) == want
    assert {r.component_id for r in got} == {0}


def test_vectors_that_share_a_number_are_told_apart(spark, monkeypatch):
    number = vector_links._number
    monkeypatch.setattr(vector_links, "_number", lambda salt: number(salt) if salt else number(0) % 2)
    rows = [(i, [float(j == i // 2) for j in range(8)]) for i in range(16)] + [(99, None)]
    got = vector_links.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {**{i: (1, i // 2 * 2) for i in range(16)}, 99: (0, 99)}


def test_cells_to_visit_may_be_the_whole_grid():
    x = np.eye(4)[:2] * 0.4 + 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.concatenate((x[:, :2], x[:, :2]), 1) / np.sqrt((x[:, :2] ** 2).sum(1, keepdims=True) * 2)
    books = x[:, :2], x[:, 2:]
    assert vector_links.cells_to_visit(x, books, 0.9, 0.98, np.random.default_rng(0)) == 4
    visited = vector_links.nearest_cells(x, books, 4)
    places = vector_links.cell_places(x, x[::-1], books)
    own = vector_links.nearest_cells(x[::-1], books, 1)
    assert [int(v[p]) for v, p in zip(visited, places, strict=True)] == own[:, 0].tolist()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(500, 501), (501, 500), (502, 502), (503, 500), (None, 4)]
    got = dict(graph.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500, 503: 500}


def test_mix(frame):
    first = mixing.Mix(frame, block_words=16)
    taken = first.taken.collect()
    size = {t: len((t or "").encode().split()) for _, t in TEXTS}
    assert Counter((r.doc_id, r["size"]) for r in taken) == Counter((i, size[t]) for i, t in TEXTS)
    sources = sorted({r.source for r in taken}, key=lambda s: (s is None, s))
    total = {s: sum(r["size"] for r in taken if r.source == s) for s in sources}
    want = mixing.targets([total[s] for s in sources], [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(total.values()), 2)
    for s, w in zip(sources, want, strict=True):
        rows = [r for r in taken if r.source == s]
        assert all(r.target == w and r.source_size == total[s] for r in rows)
        assert abs(sum(r.taken for r in rows) - w) <= 3 * 16
        assert all(r.taken <= 2 * r["size"] for r in rows)
    assert sorted(map(str, mixing.Mix(frame, block_words=16).taken.collect())) == sorted(map(str, taken))
    assert mixing.Mix(frame.limit(0)).taken.count() == 0
    texts = first.texts
    assert texts.columns == frame.columns
    words: Counter = Counter()
    for r in texts.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == Counter({i: n for i in {i for i, _ in TEXTS} if (n := sum(r.taken for r in taken if r.doc_id == i))})


def test_the_mix_by_shard_and_slot(spark):
    frame = spark.createDataFrame([(i, f"s{i % 3}", "w " * (40 + i)) for i in range(60)], "doc_id long, source string, text string")
    mix = mixing.Mix(frame, block_words=16, shards=8)
    rows = mix.mixed.collect()
    taken = {r.doc_id: r for r in mix.taken.collect()}
    words: Counter = Counter()
    for r in rows:
        words[r.doc_id] += r["to"] - r["from"]
    assert words == Counter({i: r.taken for i, r in taken.items() if r.taken})
    of: dict[int, set] = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add(r.shard)
    assert all(taken[i].n_shards == len(of.get(i, ())) for i in taken)
    # the drawn counts of each source in each shard are what the shards hold, and they are not even
    got = Counter((r.shard, r.number) for r in mix.slots.collect())
    sizes = [sum(r["size"] for r in taken.values() if r.source == f"s{k}") for k in range(3)]
    slots = [sum(n for (_, number), n in got.items() if number == k) for k in range(3)]
    drawn = mixing.draw_counts(slots, 8, 0)
    assert {k: n for k, n in got.items()} == {(i, j): int(drawn[i, j]) for i in range(8) for j in range(3) if drawn[i, j]}
    assert len(set(drawn[:, 0].tolist())) > 1 and sum(sizes) == sum(40 + i for i in range(60))
    assert {(r.number, r.slot) for r in rows} == {(k, t) for k in range(3) for t in range(slots[k])}


def test_columns_named_like_the_helpers_keep_their_values(spark):
    schema = "doc_id long, text string, source string, _id string, _key int, __key string, _copy string, _SPANS string, _h int, _none int"
    rows = [(i // 2, f"word{i // 2} b c d e f g h {i % 4 // 2}", "s", f"own{i}", i, "k", "c", "s", i, -i) for i in range(8)]
    frame = spark.createDataFrame(rows, schema)
    kept = ngram_join.one_of_each(frame, n=3, percent=80)
    assert kept.columns == frame.columns and all(r._id == f"own{r._key}" and r._none == -r._key for r in kept.collect())
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3]
    texts = mixing.Mix(frame, share=2, weights=(1,)).texts
    assert texts.columns == frame.columns and all(r._id == f"own{r._key}" and r._SPANS == "s" for r in texts.collect())
    assert Counter(r._key for r in texts.collect()) == Counter({i: 2 for i in range(8)})


def test_mix_of_long_and_empty_texts(spark):
    frame = spark.createDataFrame([(1, "a", "w " * 200_000), (2, "a", None), (3, None, ""), (4, "b", " \n")],
                                  "doc_id long, source string, text string")
    mix = mixing.Mix(frame)
    taken = {r.doc_id: r.taken for r in mix.taken.collect()}
    assert abs(taken.pop(1) - 300_000) <= 64 and taken == {2: 0, 3: 0, 4: 0}
    assert abs(sum(len(r.text.split()) for r in mix.texts.collect()) - 300_000) <= 64
    assert mixing.Mix(frame.limit(0)).texts.collect() == []


def test_mix_of_tiny_sources_meets_its_targets(spark):
    sizes = {"a": 15, "b": 33, "c": 1, "d": 70, "e": 500, "f": 4000}
    frame = spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, text string")
    got = {r.source: r for r in mixing.Mix(frame, weights=(1,), share=1.5).taken.collect()}
    assert {s: got[s].taken for s in "abcde"} == {s: 2 * sizes[s] for s in "abcde"}
    for rows in (got, {r.source: r for r in mixing.Mix(frame, weights=(1, 2), share=0.6).taken.collect()}):
        assert all(abs(r.taken - r.target) <= max(1, 0.05 * sizes[s]) for s, r in rows.items())


def test_targets():
    assert mixing.targets([10, 10, 10], [3, 1, 2], 45, 2) == [20.0, 25 / 3, 50 / 3]
    assert mixing.targets([0, 100, 100], [3, 1, 2], 300, 2) == [0.0, 100.0, 200.0]
    assert mixing.targets([], [], 0, 2) == []


def test_pipeline_stages(spark, tmp_path):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    good = [f"The small house number {i} stands near water {i * 7} and trees grow there {i * 3} quietly.\nIt is old." for i in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(good)]
    rows += [(100, good[0], "en", "s0", len(good[0])), (101, good[1] + " mail a@b.co", "en", None, 1)]
    rows += [(200 + i, "BUY!! NOW!! " * 30, "en", "s1", 9) for i in range(20)] + [(300, None, "en", "s1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 200), 0) for r in rows if r[0] < 300], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    after = [docs]
    for _, stage in corpus_pipeline.STAGES:
        after.append(stage(spark, after[-1], str(tmp_path)))
    ids = [{r.doc_id for r in d.collect()} for d in after]
    assert all(d.columns == names for d in after[1:5])
    assert ids[1] - {300} == {*range(40), 100, 101}
    assert 100 not in ids[2] and ids[2] - {300, 101} == set(range(40))
    assert not any("a@b.co" in (r.text or "") for r in after[3].collect())
    assert ids[4] <= ids[3] and ids[5] == ids[4]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == after[5].count()
