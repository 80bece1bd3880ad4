"""Personal data in texts: fixed patterns, and a skip-chain conditional random field that keeps labels consistent.

The patterns give the base spans. Tokens (runs without white space) that hold a digit or
an ``@`` are the variables of the field; any other token is surely none of the kinds. A
token in a base span has its label fixed. Neighbouring tokens share a potential. Tokens of
a document that repeat or resemble each other are tied to one shared label variable, a
star, so any number of repeats costs a tie each and is one tie away from the base span.
They share the same letters and digits, or the same last seven digits; tokens in a row
also share the letters and digits of the row, at least ``TELLS`` of them, so a number
written in pieces is tied as a whole. A base span fixes the shared label if it is told by a
whole value or at least ``TELLS`` letters and digits; a shorter piece, like a country code,
only speaks for it. Loopy message passing goes on in each text until its messages stop
changing; a free token whose label is then likelier than not becomes a span too. Base spans
always stay.

The potentials are fitted by pseudo-likelihood, with the base labels (a free token tied to
a base span is not labelled), on about ``TRAIN_ROWS`` documents at most, whole texts, each
text once: those with the smallest hashes of their texts, by a threshold from the number of
rows, so only they leave their tasks. The weights are pulled to the start values below. Every text is searched whole, in linear time.

Null and empty texts have no spans. Repeated rows get equal spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 2000
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN_END = re.compile(r"\s|$")
_NOT_KEY = re.compile(r"[^0-9a-z]+")
_CORE = re.compile(r"[+(]?[A-Za-z0-9](?:.*[A-Za-z0-9)])?", re.S)
_FEATURES = 12
TELLS = 6
_STILL = 1e-6
_ROUNDS = 10_000  # only against messages that swing for ever
Span = tuple[int, int, int]  # kind, first character, character after


def _luhn(digits: str) -> bool:
    other = [int(d) for d in reversed(digits)]
    return (sum(other[::2]) + sum(d * 2 - 9 * (d > 4) for d in other[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    emails, ips, cards, phones = [], [], [], []
    done = last = 0
    at = text.find("@")
    while at >= 0:
        before = text[max(done, last): at]
        own = len(before) - len(before.rstrip(_LOCAL))
        if own and (m := _DOMAIN.match(text, at + 1)):
            emails.append((0, at - own, m.end()))
            done = m.end()
        last = at + 1
        at = text.find("@", last)
    runs = [m.span() for m in _DIGITS.finditer(text)]
    i = 0
    while i + 3 < len(runs):
        four = runs[i: i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:], strict=False)):
            parts = [text[a:b].lstrip("0") for a, b in four]
            if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                ips.append((1, four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    i = 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
        n = sum(b - a for a, b in runs[i: j + 1])
        if 16 <= n <= 19 and _luhn("".join(text[a:b] for a, b in runs[i: j + 1])):
            cards.append((2, runs[i][0], runs[j][1]))
        i = j + 1
    if runs and "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                phones.append((3, *m.span()))
    return emails + ips + cards + phones


@dataclass
class Tokens:
    """The variables of one or more texts, with their ties."""

    text: list[int]
    span: list[tuple[int, int]]
    x: np.ndarray  # features
    label: np.ndarray  # 1 + kind where a base span fixes it, else 0
    fixed: np.ndarray
    near: np.ndarray  # pairs of neighbours
    alike: np.ndarray  # pairs of a token and the shared label it is tied to
    rows: np.ndarray  # the same for tokens in a row
    shared: np.ndarray  # shared labels: how often base spans fix it, by label


def _features(word: str, digits: str) -> list[float]:
    n, letters = len(digits), any(map(str.isalpha, word))
    return [1.0, "@" in word, word.count(".") == 3 and not letters, 1 <= n <= 4, 5 <= n <= 7, 8 <= n <= 15, 16 <= n <= 19,
            n > 19, letters, "-" in word, "(" in word or ")" in word, "+" in word]


def tokens_of(texts: list[str], spans: list[list[Span]]) -> Tokens:
    text, span, x, label, near, alike, rows, shared = [], [], [], [], [], [], [], []

    def tie(ties: list[tuple[int, int]], met: dict[str, int], key: str, members: list[int], told: int) -> None:
        hub = met.setdefault(key, len(shared))
        if hub == len(shared):
            shared.append([0] * 5)
        shared[hub][told] += told > 0
        ties.extend((m, hub) for m in members)

    for i, (t, own) in enumerate(zip(texts, spans, strict=True)):
        places = sorted([m.start() for m in _DIGITS.finditer(t)] + [k for k, c in enumerate(t) if c == "@"] if "@" in t
                        else [m.start() for m in _DIGITS.finditer(t)])
        covered = sorted((a, b, k) for k, a, b in own)
        met: dict[str, int] = {}
        row: list[tuple[int, str, Span | None]] = []  # this token and those right before it: number, key, base span
        end = c = 0
        for place in places:
            if place < end:
                continue
            begin = place
            while begin > end and not t[begin - 1].isspace():
                begin -= 1
            before, end = end, _TOKEN_END.search(t, place).start()
            word = t[begin:end]
            digits = "".join(_DIGITS.findall(word))
            while c < len(covered) and covered[c][1] <= begin:
                c += 1
            hit = next(((a, b, k) for a, b, k in covered[c: c + 4] if a < end and b > begin), None)
            me, own = len(text), 0 if hit is None else 1 + hit[2]
            key = _NOT_KEY.sub("", word.lower())
            if me and text[-1] == i and t[before:begin].isspace():
                near.append((me - 1, me))
            else:
                row = []
            whole = hit is not None and begin <= hit[0] and hit[1] <= end
            if key:
                tie(alike, met, key, [me], own if whole or len(key) >= TELLS else 0)
            if len(digits) >= 7:
                tie(alike, met, "-" + digits[-7:], [me], own)
            row = [*row[1 - TELLS:], (me, key, hit)] if key else []
            for n in range(2, len(row) + 1):
                if sum(len(k) for _, k, _ in row[-n:]) >= TELLS:
                    tie(rows, met, " ".join(k for _, k, _ in row[-n:]), [m for m, _, _ in row[-n:]],
                        own if all(h == hit for _, _, h in row[-n:]) else 0)
                    break
            text.append(i)
            span.append((begin, end))
            x.append(_features(word, digits))
            label.append(own)
    rows = [(m, hub) for m, hub in rows if any(shared[hub])]  # a row that no base span tells is no tie among its own tokens
    return Tokens(text, span, np.array(x, float).reshape(-1, _FEATURES), np.array(label, int), np.array(label, int) > 0,
                  np.array(near, int).reshape(-1, 2), np.array(alike, int).reshape(-1, 2), np.array(rows, int).reshape(-1, 2), np.array(shared, float).reshape(-1, 5))


@dataclass
class Field:
    own: np.ndarray  # label by feature
    near: np.ndarray  # label by label, of neighbours
    alike: np.ndarray  # of tied tokens


def start_field() -> Field:
    """Few tokens are personal; neighbours tell little; tied tokens mostly agree."""
    own = np.zeros((5, _FEATURES))
    own[0, 0] = 2.0
    return Field(own, 0.2 * np.eye(5), 3.0 * np.eye(5))


def fit(tokens: Tokens, steps: int = 200, pull: float = 0.01) -> Field:
    """Pseudo-likelihood: each label given its neighbours' labels and those of the others tied to what it is tied to.

    Ties of rows are left out, as they would tell a token of its own row's labels, which its neighbours do.
    """
    field = start_field()
    member, hub = tokens.alike.T
    y = np.eye(5)[tokens.label]
    told = np.zeros((len(tokens.shared), 5))
    np.add.at(told, hub, y[member])
    others = told[hub] - y[member]
    unknown = ~tokens.fixed & (np.bincount(member, told[hub, 1:].sum(1) > 0, len(y)) > 0)
    unknown[tokens.rows[:, 0]] = ~tokens.fixed[tokens.rows[:, 0]]
    y[unknown] = 0
    n = int((~unknown).sum())
    if not n:
        return field
    personal = others[:, 1:].sum(1)
    others[(personal > 0) | tokens.fixed[member], 0] = 0
    others /= np.maximum(others.sum(1, keepdims=True), 1)
    tied = np.zeros_like(y)
    np.add.at(tied, member, others)
    around = np.zeros_like(y)
    np.add.at(around, tokens.near[:, 0], y[tokens.near[:, 1]])
    np.add.at(around, tokens.near[:, 1], y[tokens.near[:, 0]])
    sides = (around, tied)
    start = (field.own.copy(), field.near.copy(), field.alike.copy())
    for _ in range(steps):
        score = tokens.x @ field.own.T + sides[0] @ field.near + sides[1] @ field.alike
        p = np.exp(score - score.max(1, keepdims=True))
        gap = (y - p / p.sum(1, keepdims=True)) * ~unknown[:, None] / n
        field.own += 0.5 * (gap.T @ tokens.x - pull * (field.own - start[0]))
        for k, name in enumerate(("near", "alike")):
            step = sides[k].T @ gap
            now = getattr(field, name)
            setattr(field, name, now + 0.5 * ((step + step.T) / 2 - pull * (now - start[1 + k])))
    return field


def marginals(tokens: Tokens, field: Field, rounds: int = _ROUNDS) -> np.ndarray:
    """Loopy sum-product over all tokens at once; each text goes on until its own messages stand still."""
    n, seen = len(tokens.label), tokens.shared.sum(1)
    own = np.concatenate((tokens.x @ field.own.T, np.zeros((len(seen), 5))))
    fixed = np.concatenate((tokens.fixed, seen > 0))
    own[:n][tokens.fixed] = -1e6
    own[:n][tokens.fixed, tokens.label[tokens.fixed]] = 0
    share = tokens.shared[seen > 0] / seen[seen > 0, None]
    own[n:][seen > 0] = np.where(share > 0, np.log(np.maximum(share, 1e-300)), -1e6)
    ties = np.concatenate((tokens.near, tokens.alike + [0, n], tokens.rows + [0, n]))
    pairs = np.concatenate((ties, ties[:, ::-1]))
    kind = np.tile(np.repeat([0, 1], [len(tokens.near), len(tokens.alike) + len(tokens.rows)]), 2)
    back = np.roll(np.arange(len(pairs)), len(ties))
    text = np.tile(np.array(tokens.text, int)[ties[:, 0]], 2)
    bonds, sent = np.stack((field.near, field.alike)), np.zeros((len(pairs), 5))
    live = np.arange(len(pairs))
    for _ in range(rounds):
        if not len(live):
            break
        belief = own.copy()
        np.add.at(belief, pairs[live, 1], sent[live])
        source = pairs[live, 0]
        told = np.where(fixed[source, None], own[source], belief[source] - sent[back[live]])[:, :, None] + bonds[kind[live]]
        top = told.max(1, keepdims=True)
        new = (top + np.log(np.exp(told - top).sum(1, keepdims=True)))[:, 0]
        new -= new.max(1, keepdims=True)
        change = np.zeros(text.max() + 1)
        np.maximum.at(change, text[live], np.abs(new - sent[live]).max(1))
        sent[live] = 0.5 * sent[live] + 0.5 * new
        live = live[change[text[live]] > _STILL]
    belief = own
    np.add.at(belief, pairs[:, 1], sent)
    belief = belief[:n]
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind and start."""
    base = [base_spans(t) for t in texts]
    tokens = tokens_of(texts, base)
    added: list[list[Span]] = [[] for _ in texts]
    if not tokens.fixed.all():
        p = marginals(tokens, field)
        joined = {(int(a), int(b)) for a, b in tokens.near}
        last = -1
        for i in np.flatnonzero(~tokens.fixed & (p[:, 1:].max(1) > 0.5)).tolist():
            kind, where = int(p[i, 1:].argmax()), tokens.text[i]
            begin, end = tokens.span[i]
            core = _CORE.search(texts[where], begin, end)
            begin, end = core.span() if core else (begin, end)
            own = added[where]
            if own and last == i - 1 and (i - 1, i) in joined and own[-1][0] == kind:
                own[-1] = (kind, own[-1][1], end)
            else:
                own.append((kind, begin, end))
            last = i
    return [(b, sorted([*b, *a]) if a else b) for b, a in zip(base, added, strict=True)]


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, joined where they overlap, replaced by its kind in brackets."""
    out, done = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def train(documents: DataFrame, rows: int = TRAIN_ROWS) -> Field:
    """Field from the texts with a digit or an @ among those whose hash is in the share that ``rows`` are of all."""
    share = min(1.0, rows / max(1, documents.count()))
    low = F.pmod(F.xxhash64("text"), F.lit(1 << 32)) < int(share * (1 << 32))
    told = documents.filter(F.col("text").isNotNull() & low & F.col("text").rlike("[0-9@]")).select("text").distinct().collect()
    texts = sorted((r.text for r in told), key=str.encode)
    return fit(tokens_of(texts, [base_spans(t) for t in texts]))


def detect(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, text, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted), one row per document.

    The counts and the digest are those of the base spans; ``spans`` lists all.
    """
    shared = documents.sparkSession.sparkContext.broadcast(field or train(documents))
    names = ["doc_id", "text", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = find(texts, shared.value)
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(spans_text(b).encode()).hexdigest() for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), *counts, pa.array(digests, pa.string()),
                 pa.array([spans_text(s) for _, s in found], pa.string()),
                 pa.array([redact(t, s) for t, (_, s) in zip(texts, found, strict=True)], pa.string())], names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, text string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "redacted string")


def redact_documents(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """``documents`` with all spans of the texts replaced by their kind; n_chars follows, if there is one. Null stays null."""
    shared = documents.sparkSession.sparkContext.broadcast(field or train(documents))
    names, at = documents.columns, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = find([t or "" for t in texts], shared.value)
            clean = [None if t is None else redact(t, s) for t, (_, s) in zip(texts, found, strict=True)]
            yield batch.set_column(at, "text", pa.array(clean, batch.schema.field(at).type))

    out = documents.mapInArrow(run, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in names else out
