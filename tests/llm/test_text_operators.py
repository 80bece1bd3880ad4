"""Substring removal, n-gram join, fingerprints, personal data and line quality against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sightline.llm import digests, line_quality, ngram_join, personal_data, substrings

SCHEMA = "doc_id long, text string, lang string, h string, score string"


@pytest.fixture
def frame(spark):
    return lambda texts: spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in texts], SCHEMA)


def some_texts(seed: int, n: int = 60) -> list[tuple[int, str | None]]:
    """Copies, near copies, shared passages, very short and odd texts; ids with gaps."""
    r = random.Random(seed)
    word = [f"w{i}" for i in range(400)] + ["Ärger", "X", "a\u00a0b", "#", "naïve"]
    passage = " ".join(r.choices(word, k=50))
    out: list[tuple[int, str | None]] = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two three")]
    while len(out) < n:
        kind, i = r.random(), 10 + 3 * len(out)
        old = r.choice([t for _, t in out if t])
        if kind < 0.15:
            text = old
        elif kind < 0.4:
            words = old.split(" ")
            words[r.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind < 0.6:
            text = " ".join(r.choices(word, k=r.randint(0, 60))) + " " + passage + "\n" + " ".join(r.choices(word, k=20))
        else:
            text = " ".join(r.choices(word, k=r.randint(1, 150)))
        out.append((i, text))
    return [*out, out[-1], out[7]]  # two repeated rows


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def test_a_phrase_in_many_contexts_is_cut_into_several_automata(frame):
    r = random.Random(9)
    word = [f"w{i}" for i in range(50)]
    phrase = " ".join(r.choices(word, k=12))
    rows = [(i, " ".join(r.choices(word, k=10)) + f" {phrase} " + " ".join(r.choices(word, k=10))) for i in range(60)]
    rows += [(100 + i, " ".join(rows[i][1].split(" ")[2:-2])) for i in range(0, 60, 7)]
    want = {i: sum(gone) for i, gone in _gone(rows, 14).items()}
    got = {x.doc_id: x.n_removed for x in substrings.remove_repeats(frame(rows), 14, 6, 5).collect()}
    assert got == want and any(want.values()) and not all(want.values())


def _gone(rows, n):
    seen = Counter(b" ".join(w[i: i + n]) for w in (words_of(t) for _, t in rows) for i in range(len(w) - n + 1))
    out = {}
    for i, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        for at in range(len(words) - n + 1):
            if seen[b" ".join(words[at: at + n])] > 1:
                gone[at: at + n] = [True] * n
        out[i] = gone
    return out


@pytest.mark.parametrize(("n", "k", "group"), [(35, 12, 1000), (8, 3, 2)])
def test_substrings(frame, n, k, group):
    rows = some_texts(n)
    seen = Counter(b" ".join(w[i: i + n]) for w in (words_of(t) for _, t in rows) for i in range(len(w) - n + 1))
    want = []
    for i, text in rows:
        words = words_of(text)
        gone = set()
        for at in range(len(words) - n + 1):
            if seen[b" ".join(words[at: at + n])] > 1:
                gone |= set(range(at, at + n))
        kept = b" ".join(w for at, w in enumerate(words) if at not in gone)
        want.append((i, len(words), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in substrings.remove_repeats(frame(rows), n, k, group).collect()]
    assert sorted(got) == sorted(want)
    assert any(w[2] for w in want)


def test_suffix_automaton_counts_every_substring():
    r = random.Random(3)
    strings = ["".join(r.choices("ab", k=r.randint(1, 9))) for _ in range(12)]
    automaton = substrings.SuffixAutomaton()
    for s in strings:
        automaton.add(s, 2)
    automaton.count()
    for s in strings:
        for n in (1, 2, 3):
            for end, (length, seen) in enumerate(automaton.matches(s, n)):
                part = s[max(0, end - n + 1): end + 1]
                assert length == len(part)
                assert seen == 2 * sum(t.startswith(part, i) for t in strings for i in range(len(t)))


def components_of(rows, n: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words_of(text)]
        sets[i] = {tuple(w[a: a + n]) for a in range(max(1, len(w) - n + 1))} if w else set()
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and low[b] < low[a]:
                    low[a], changed = low[b], True
    return {i: (len(s), low[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (2, 40)])
def test_ngram_join(frame, n, percent):
    rows = some_texts(n)
    want = components_of(rows, n, percent)
    got = ngram_join.join_similar(frame(rows), n, percent).collect()
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)
    assert len({c for _, c in want.values()}) < len(want)
    kept = ngram_join.one_of_each(frame(rows), n, percent)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    wordless = [i for i, t in rows if not words_of(t)]  # all of them stay, repeated rows too
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*wordless, *({c for _, c in want.values()} - set(wordless))])


def test_unlike_sets_of_one_name_stay_apart(frame):
    """With two bits for the first hash nearly all sets share their name; the second hash tells them apart."""
    rows = some_texts(4)
    want = components_of(rows, 4, 85)
    got = ngram_join.join_similar(frame(rows), 4, 85, bits=2).collect()
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)


def test_parities_bound_the_difference_and_tell_unrelated_long_texts(spark):
    r = np.random.default_rng(3)
    rows = []
    for size, changed in [(3, 1), (40, 5), (700, 60), (1030, 10), (2047, 30), (2050, 300), (9000, 700), (6000, 6000), (18000, 18000)]:
        x = r.integers(0, 2**63, size, dtype=np.uint64)
        y = np.concatenate((x[changed:], r.integers(0, 2**63, changed + size // 20, dtype=np.uint64)))
        sizes = np.array([len(x), len(y)])
        odd = ngram_join.parities(np.repeat([0, 1], sizes), np.concatenate((x, y)), sizes).to_pylist()
        rows.append((*odd, len(np.setxor1d(x, y)), size, changed))
    told = spark.createDataFrame(rows, "x array<bigint>, y array<bigint>, unlike int, size int, changed int").selectExpr(
        "*", ngram_join.fewest_unlike("x", "y") + " as low", "size(x) < size(y) as merged").collect()
    assert any(t.merged for t in told)
    for t in told:
        assert t.low <= t.unlike
        if t.size == t.changed:  # nothing in common: known without the texts
            assert 185 * t.low > 15 * (2 * t.size + t.size // 20)


def test_ngram_join_long_texts(frame):
    """Texts whose parts differ in number, and long texts with nothing but a passage in common."""
    r = random.Random(8)
    long = [[f"w{r.randrange(10**6)}" for _ in range(size)] for size in (1000, 1020, 2040, 5000, 5000)]
    passage = [f"p{i}" for i in range(400)]
    rows = []
    for i, words in enumerate(long):
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words + words[:40])),
                 (10 * i + 2, " ".join(words + [f"n{i} {j}" for j in range(len(words) // 25)])),
                 (10 * i + 3, " ".join(words[len(words) // 2:] + passage))]
    got = {x.doc_id: x.component_id for x in ngram_join.join_similar(frame(rows)).collect()}
    assert got == {i: c for i, (_, c) in components_of(rows, 4, 85).items()}
    assert got[42] == got[41] == 40 and got[43] == 43


def test_ngram_join_null_ids_and_empty_table(frame):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, "other words here at last"), (7, "a b c d e"), (None, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_similar(frame(rows)).collect()}
    assert got == {(None, 2, 7), (7, 2, 7), (None, 2, None), (None, 0, None)}
    assert ngram_join.join_similar(frame(rows).limit(0)).count() == 0
    assert substrings.remove_repeats(frame(rows).limit(0), 3, 2).count() == 0
    assert digests.fingerprints(frame(rows).limit(0)).count() == 0


@pytest.mark.parametrize("last", [None, 400])
def test_fingerprints(frame, last):
    rows = [(i, t) for i, t in some_texts(5)[:-2]] + [(last, "the last one in order, " * 30)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r.doc_id: r for r in digests.fingerprints(frame(rows)).collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(order):
        text, other = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (digests.digest(text), digests.digest(edited))
        assert r.near_edited == digests.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == digests.likeness(r.fingerprint, digests.digest(other))
    assert digests.likeness(digests.digest("abc"), digests.digest("abc")) == 1
    assert digests.digest("abc") != digests.digest("abd")


def test_fingerprint_likeness_tells_edits_from_others():
    r = random.Random(1)
    word = ["".join(r.choices("etaoinshr", k=r.randint(2, 9))) for _ in range(3000)]
    text, other = (" ".join(r.choices(word, k=300)) for _ in range(2))
    edited = text.replace(" ", "  ", 5) + " more"
    near, far = (digests.likeness(digests.digest(text), digests.digest(x)) for x in (edited, other))
    assert 0 <= far < 0.7 < near <= 1


def pattern_spans(t: str):
    digits = lambda s: re.sub("[^0-9]", "", s)
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(2)
    for alphabet in ("a1@.", "1 -", "+1() .-2", "ab@.-1_ ", "0123456789 -.+@a"):
        for _ in range(3000):
            text = "".join(r.choices(alphabet, k=r.randint(0, 40)))
            assert personal_data.base_spans(text) == pattern_spans(text), text


def test_personal_data(frame):
    card = "4111 1111 1111 1111"
    text = f"Ä +1 (017) 555-7713 then (017) 555-7713; card {card}, 4111-1111-1111-1111 a@b.co 10.0.0.300 10.0.0.3"
    rows = [(1, text), (2, None), (3, ""), (4, "9" * 50_000 + "@" * 50_000), (1, text)]
    got = personal_data.detect(frame(rows), personal_data.start_field()).collect()
    assert len(got) == 5
    for r, (_, t) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows, key=lambda x: x[0]), strict=True):
        base = pattern_spans(t) if t and len(t) < 1000 else []
        assert r.base_sha256 == hashlib.sha256(personal_data.spans_text(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert set(personal_data.spans_text(base).split(",")) <= set(r.spans.split(","))
    found = next(r for r in got if r.doc_id == 1)
    assert found.spans.count("phone") == 2  # the repeated one has no plus sign
    assert "555" not in found.redacted and card not in found.redacted and found.redacted.startswith("Ä [PHONE]")


def test_repeated_label_reaches_a_token_far_away():
    text = "+49 30 1234567 " + "word " * 500 + "1234567"
    field = personal_data.start_field()
    (base, every), = personal_data.find([text], field)
    assert len(base) == 1 and len(every) == 2
    field.alike[:] = 0
    assert personal_data.find([text], field)[0][1] == base


@pytest.mark.parametrize("repeats", [2, 5, 50])
def test_every_repeat_of_a_number_is_found_with_the_trained_field(frame, repeats):
    rows = [(i, f"call +49 30 {1000000 + 7919 * i} or a{i}@b.co, {i} of {i % 7} and 10{i}") for i in range(300)]
    field = personal_data.train(frame(rows))
    for base, again in (("+49 30 1234567", "1234567"), ("+1 (017) 555 7713", "(017) 555 7713"), ("+1 (826) 555-4081", "(826) 555-4081")):
        text = base + f" word {again} word" * repeats
        (own, every), = personal_data.find([text], field)
        assert [text[a:b] for _, a, b in own] == [base]
        assert [(k, text[a:b]) for k, a, b in every] == [(3, base)] + [(3, again)] * repeats
    alone = "+49 30 1234567" + " word 30 word" * repeats  # a piece of a number is no repeat of it
    assert len(personal_data.find([alone], field)[0][1]) <= 1 + (repeats == 1)


def exact_marginals(tokens, field):
    """By all labellings of the free variables; a shared label that base spans fix must have one label."""
    import itertools

    n, m = len(tokens.label), len(tokens.shared)
    seen = tokens.shared.sum(1) > 0
    assert ((tokens.shared > 0).sum(1) <= 1).all()
    known: list[int | None] = [int(tokens.label[i]) if tokens.fixed[i] else None for i in range(n)]
    known += [int(tokens.shared[k].argmax()) if seen[k] else None for k in range(m)]
    free = [i for i, v in enumerate(known) if v is None]
    own = tokens.x @ field.own.T
    bonds = [(a, b, field.near) for a, b in tokens.near.tolist()]
    bonds += [(a, b + n, field.alike) for a, b in tokens.alike.tolist() + tokens.rows.tolist()]
    total = np.zeros((n, 5))
    for labels in itertools.product(range(5), repeat=len(free)):
        y = list(known)
        for i, v in zip(free, labels, strict=True):
            y[i] = v
        weight = np.exp(sum(own[i, y[i]] for i in free if i < n) + sum(bond[y[a], y[b]] for a, b, bond in bonds))
        total[np.arange(n), y[:n]] += weight
    return total / total.sum(1, keepdims=True), len(free), len(bonds)


@pytest.mark.parametrize(("text", "most"), [
    ("a@b.co 12", 1e-4), ("12 34 x 56", 1e-4), ("call 1234 or 1234", 1e-4), ("+49 30 1234567 or 1234567", 1e-4),
    ("4111111111111111 99", 1e-4), ("a@b.co x 12 a@b.co", 1e-4), ("12 12 x", 0.1), ("123 45 x 45 123", 0.1)])
def test_marginals_against_all_labellings(text, most):
    r = np.random.default_rng(len(text))
    field = personal_data.start_field()
    field.own += r.normal(size=field.own.shape) * 0.3
    field.near += r.normal(size=(5, 5)) * 0.1
    field.near = (field.near + field.near.T) / 2
    tokens = personal_data.tokens_of([text], [personal_data.base_spans(text)])
    exact, free, _ = exact_marginals(tokens, field)
    got = personal_data.marginals(tokens, field)
    assert free or tokens.fixed.all()
    assert np.abs(got - exact).max() < most  # loops are told to a tenth
    field.alike = np.zeros((5, 5))
    if text.startswith("+49"):  # without its tie the repeat is not told
        assert np.abs(personal_data.marginals(tokens, field) - exact).max() > 0.3


def test_the_sample_is_whole_texts_of_bounded_number(frame):
    rows = [(i, f"text {i} " + "word " * 8000 + f"tail{i}@b.co") for i in range(40)] + [(100 + i, "copy 1") for i in range(400)]
    seen = []
    fit, personal_data.fit = personal_data.fit, lambda tokens: seen.append(tokens) or fit(tokens)
    try:
        personal_data.train(frame(rows), rows=10_000)
        assert len(set(seen[0].text)) == 41  # every text once, whole: its address is at the end
        assert (seen[0].label == 1).sum() == 40
        personal_data.train(frame(rows), rows=44)
        assert 0 <= len(set(seen[1].text)) < 20  # a tenth of the texts; four hundred copies cannot fill it
        personal_data.train(frame([]))
    finally:
        personal_data.fit = fit


def test_messages_settle_alike_whatever_texts_come_with_a_text():
    texts = ["+49 30 1234567 and " + "1234567 x " * 40, "1 2 3 4 5 6 7 8 9 " * 200, "a@b.co 12 a@b.co"]
    together = personal_data.find(texts, personal_data.start_field())
    assert together == [personal_data.find([t], personal_data.start_field())[0] for t in texts]


def test_line_quality(frame, spark):
    r = random.Random(4)
    good = ["\n".join(" ".join(r.choices(["the", "house", "stands", "near", "water", "and", "trees"], k=9)) + "." for _ in range(5))
            for _ in range(60)]
    bad = [t.upper().replace(" ", "!! ") for t in good[:30]] + ["buy " * 40 for _ in range(10)]
    rows = list(enumerate(good + bad))
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in rows if i % 3], "doc_id long, label int")
    model = line_quality.train(frame(rows), labels)
    scored = line_quality.score(frame([*rows, (900, None), (901, ""), (902, "\n\n"), (903, "x" * 300_000)]), model)
    assert scored.columns == ["doc_id", "text", "lang", "h", "score"]
    score = {x.doc_id: x.score for x in scored.collect()}
    assert all(0 <= s <= 1 for s in score.values()) and score[900] == score[901]
    held = [i for i, _ in rows if i % 3 == 0]
    assert min(score[i] for i in held if i < 60) > max(score[i] for i in held if i >= 60)
    assert line_quality.score(frame([]), model).count() == 0


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(0)
    own, bonds = rng.normal(size=(1, 5, 2)), rng.normal(size=(2, 2))
    total, marginal, pairs = 0.0, np.zeros((5, 2)), np.zeros((2, 2))
    for code in range(32):
        y = [code >> i & 1 for i in range(5)]
        p = np.exp(sum(own[0, i, y[i]] for i in range(5)) + sum(bonds[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += p
        for i in range(5):
            marginal[i, y[i]] += p
        for a, b in zip(y, y[1:], strict=False):
            pairs[a, b] += p
    got, expected = line_quality._batch_pass(own, np.ones((1, 5), bool), bonds, np.ones(1))
    assert np.allclose(got[0], marginal / total) and np.allclose(expected, pairs / total)
