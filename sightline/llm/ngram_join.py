"""Similarity join of documents on n-gram Jaccard, by rare-first prefix filtering.

Copies are merged first: documents with one set of n-grams are one class, told by an
order-free 128-bit hash of the set. The first half names the class; where sets that
differ in the second half share a name, the second half takes its place. Such names come
by chance only, n * n / 2^65 of them for n documents (about three in 10^10), so the
driver can hold their list. Everything after works on classes.

1. One pass over the texts gives each document its set hash and counts every n-gram in
   ``BUCKETS`` hash buckets. The counts cover all documents and have a fixed size, so
   they are broadcast. They fix the order: n-grams of rare buckets first, then by hash.
   Any order gives the same result; rare first gives few candidates.
2. Two sets that are similar enough share an n-gram among their first |x| - ceil(t|x|) + 1.
   These prefixes are dealt out by n-gram and sorted by size. One streaming pass notes
   for each row the first class of its n-gram, its leader.
3. First round: each class is verified against the leader it shares most prefix n-grams
   with, if length and position allow the pair. Classes of one group of near copies
   mostly meet here, with one pair per class.
   ``MORE_ROUNDS`` further rounds do the same with n-grams that still lie in several
   components. Their leader is a member of the largest one, another for each n-gram, and
   each class tries the ``LEADERS`` it shares most with.
4. Last round: the prefix join proper, between classes that are not connected yet.
   Length, positional and suffix filters are part of the join condition. The suffix
   filter cuts both sets into the same parts by hash, as the recursive one does; parts
   whose sizes differ in parity hold an n-gram of one set only, so their number bounds the
   difference from below. A set has at least half as many parts as n-grams (``parts_of``),
   for fewer would say nothing; of two sets the larger one's parts are merged to the
   smaller one's. A pair is not made at an n-gram if an earlier one, among the first
   ``HEAD`` of both, makes it already; the filters must pass at a pair's first common
   n-gram, so none is lost. Pairs verified before are left out. A pair whose ends are already
   connected cannot change the result, so a group never spreads into all its pairs.
5. Verified pairs give the components.

Empty and null texts have no n-gram and link with nothing. A text with fewer words than
``n`` is one gram. Repeated rows are equal sets, also under one id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.columns import document_key, key_of, unused
from sightline.llm.graph import components
from sightline.llm.words import batch_chunks, gram_hashes, hash_words, mix
from sightline.session import materialise

BUCKETS = 1 << 16
LEAST_PARTS, MOST_PARTS = 512, 8192
REMEMBERED = 200_000
MORE_ROUNDS, LEADERS, HEAD = 2, 3, 8
_A, _B, _C = np.uint64(0xD1342543DE82EF95), np.uint64(0xF1357AEA2E62A9C5), np.uint64(0x9FB21C651E98DF25)


def gram_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of the distinct n-grams, sorted; A-Z lower-cased."""
    words, first = hash_words([x.lower() for x in texts])
    size = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), size)
    place = np.arange(len(words)) - first[owner]
    at = place + n <= size[owner]
    owners, grams = [owner[at]], [gram_hashes(words, n, _A)[at]]
    for few in range(1, n):
        at = (size[owner] == few) & (place == 0)
        if at.any():
            owners.append(owner[at])
            grams.append(mix(gram_hashes(words, few, _A)[at] + np.uint64(few)))
    owner, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.lexsort((gram, owner))
    owner, gram = owner[order], gram[order]
    new = np.ones(len(gram), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])
    return owner[new], gram[new]


def set_hashes(owner: np.ndarray, gram: np.ndarray, n_texts: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first and second hash of each text's set, size of each); the first one has ``bits`` bits."""
    size = np.bincount(owner, minlength=n_texts)

    def hashes(salt: np.uint64) -> np.ndarray:
        sums = np.zeros(n_texts, np.uint64)
        if len(gram):
            sums[size > 0] = np.add.reduceat(mix(gram ^ salt), (np.cumsum(size) - size)[size > 0])
        return mix(sums + size.astype(np.uint64))

    return (hashes(_B) >> np.uint64(64 - bits)).view(np.int64), hashes(_C).view(np.int64), size


def parts_of(size: np.ndarray) -> np.ndarray:
    """Parts of sets of these sizes: powers of two."""
    half = np.clip((size + 1) // 2, LEAST_PARTS, MOST_PARTS)
    return np.int64(1) << np.ceil(np.log2(half)).astype(np.int64)


def parities(owner: np.ndarray, gram: np.ndarray, size: np.ndarray) -> pa.ListArray:
    """For each set, one bit for each of its parts: whether it holds an odd number of n-grams."""
    parts = parts_of(size)
    first = np.concatenate(([0], np.cumsum(parts)))
    cell = first[owner] + ((gram >> np.uint64(20)).astype(np.int64) & (parts[owner] - 1))
    odd = np.bincount(cell, minlength=first[-1]) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array((first // 64).astype(np.int32)), pa.array(words))


def fewest_unlike(x: str, y: str) -> str:
    """SQL: a lower bound of the n-grams only one of two sets has, from their parities; x is not larger than y."""
    merged = f"if(size({y}) > size({x}), {y}[i + size({x})], 0L)"
    each = f"transform({x}, (v, i) -> bit_count(v ^ {y}[i] ^ {merged}))"
    return f"if(size({y}) > 2 * size({x}), 0, aggregate({each}, 0, (s, v) -> s + v))"


def _classes(n: int, bits: int):
    names = ["doc_id", "h", "n_shingles", "sid", "other", "odd", "bucket", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part, texts in batch_chunks(batch):
                owner, gram = gram_sets(texts, n)
                sid, other, size = set_hashes(owner, gram, len(texts), bits)
                counts += np.bincount((gram >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array(size), pa.array(sid, mask=size == 0),
                     pa.array(other, mask=size == 0), parities(owner, gram, size), pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.int64())],
                    names)
        at = np.flatnonzero(counts)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none] * 5 + [pa.nulls(len(at), pa.list_(pa.int64())), pa.array(at.astype(np.int32)), pa.array(counts[at])], names)

    return run


def _prefixes(n: int, percent: int, often, bits: int, shared_names: list[int]):
    shared_names = np.array(shared_names, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = often.value, set()
        for batch in batches:
            for _, texts in batch_chunks(batch):
                owner, gram = gram_sets(texts, n)
                sid, other, size = set_hashes(owner, gram, len(texts), bits)
                sid = np.where(np.isin(sid, shared_names), other, sid)
                fresh = np.zeros(len(texts), bool)
                for i in np.flatnonzero(size):  # copies in one task add nothing
                    fresh[i] = sid[i] not in met
                    met.add(sid[i])
                if len(met) > REMEMBERED:
                    met.clear()
                order = np.lexsort((gram, counts[(gram >> np.uint64(48)).astype(np.int64)], owner))
                owner, gram = owner[order], gram[order]
                place = np.arange(len(gram)) - (np.cumsum(size) - size)[owner]
                prefix = size - (size * percent + 99) // 100 + 1
                at = fresh[owner] & (place < prefix[owner])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[at].view(np.int64)), pa.array(sid[owner[at]]),
                     pa.array(size[owner[at]].astype(np.int32)), pa.array(place[at].astype(np.int32))],
                    ["gram", "sid", "size", "place"])

    return run


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of n-grams that two classes have, each with the first row of its n-gram. Rows come sorted."""
    held, leader = None, None
    names = ["gram", "sid", "size", "place", "l_sid", "l_size", "l_place"]

    def rows(gram, own, last):
        nonlocal leader
        if not len(gram):
            return None
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        if leader is not None and leader[0] == gram[0]:
            new[0] = False
        at = np.maximum.accumulate(np.where(new, np.arange(len(gram)), -1))
        lead = [np.where(at >= 0, x[at], leader[i + 1] if leader is not None else 0) for i, x in enumerate(own)]
        alone = new & np.concatenate((new[1:], [last is None or last != gram[-1]]))
        leader = (gram[-1], *(x[-1] for x in lead))
        return pa.RecordBatch.from_arrays([pa.array(x[~alone]) for x in (gram, *own, *lead)], names)

    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names[:4]]
        if held is not None:
            columns = [np.concatenate((x, y)) for x, y in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        fresh = np.ones(len(columns[0]), bool)  # copies of one class come from several tasks
        fresh[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        columns = [x[fresh] for x in columns]
        held = [x[-1:] for x in columns]  # what follows it is not known yet
        if (out := rows(columns[0][:-1], [x[:-1] for x in columns[1:]], columns[0][-1])) is not None:
            yield out
    if held is not None:
        yield rows(held[0], held[1:], None)


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, left in batch_chunks(batch, "a_text"):
                right = [x or b"" for x in part.column("b_text").cast(pa.large_binary()).to_pylist()]
                sides = [gram_sets(x, n) for x in (left, right)]
                sizes = [np.bincount(o, minlength=len(left)) for o, _ in sides]
                owner = np.concatenate([o for o, _ in sides])
                gram = np.concatenate([g for _, g in sides])
                order = np.lexsort((gram, owner))
                owner, gram = owner[order], gram[order]
                both = (owner[1:] == owner[:-1]) & (gram[1:] == gram[:-1])
                shared = np.bincount(owner[1:][both], minlength=len(left))
                linked = 100 * shared >= percent * (sizes[0] + sizes[1] - shared)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(linked)], ["a", "b", "linked"])

    return run


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs (a, b); ``texts`` has (sid, text)."""
    both = pairs.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(_verify(n, percent), "a long, b long, linked boolean")


def similar_classes(base: DataFrame, n: int, percent: int, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(documents with n_shingles and sid, links between classes (a, b)); ``base`` has doc_id, h, text.

    ``bits`` of the first hash name a class; fewer than 64 make sets share names, for tests.
    """
    spark = base.sparkSession
    told = materialise(base.mapInArrow(
        _classes(n, bits), "doc_id long, h long, n_shingles long, sid long, other long, odd array<bigint>, bucket int, times long"),
        "gram-sets")
    documents = told.filter("bucket is null").drop("bucket", "times")
    halves = documents.groupBy("sid").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    shared_names = [r.sid for r in halves.filter("low < high").select("sid").collect()]
    if shared_names:
        documents = documents.withColumn("sid", F.when(F.col("sid").isin(shared_names), F.col("other")).otherwise(F.col("sid")))
    documents = documents.drop("other")
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, times in told.filter("bucket is not null").groupBy("bucket").agg(F.sum("times")).collect():
        counts[bucket] = times
    often = spark.sparkContext.broadcast(counts)

    prefixes = base.mapInArrow(_prefixes(n, percent, often, bits, shared_names), "gram long, sid long, size int, place int")
    shared = materialise(
        prefixes.repartition("gram").sortWithinPartitions("gram", "size", "sid", "place")
        .mapInArrow(_lead, "gram long, sid long, size int, place int, l_sid long, l_size int, l_place int"),
        "shared-grams")

    def allowed(a: str, b: str) -> str:
        """Length and positional filter; a is not larger than b."""
        return (f"100L * {a}size >= {percent} * {b}size and {100 + percent}L * least({a}size - {a}place, "
                f"{b}size - {b}place) >= {percent} * (0L + {a}size + {b}size)")

    first = (
        shared.filter("sid <> l_sid").filter(allowed("l_", ""))
        .groupBy("sid", "l_sid").agg(F.count("*").alias("times"))
        .groupBy("sid").agg(F.max_by("l_sid", F.struct("times", "l_sid")).alias("l_sid"))
        .select(F.least("sid", "l_sid").alias("a"), F.greatest("sid", "l_sid").alias("b")).distinct()
    )
    first = materialise(first, "leader-pairs")
    classes = materialise(
        documents.filter("sid is not null").groupBy("sid").agg(
            F.min(F.struct("doc_id", "h")).alias("at"), F.first("odd").alias("odd")), "classes")
    # only classes that some n-gram brings to another one are ever verified
    at = shared.filter("sid <> l_sid").select(F.explode(F.array("sid", "l_sid")).alias("sid")).distinct()
    wanted = at.join(classes, "sid").select("sid", "at.doc_id", "at.h")
    texts = materialise(
        base.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
                             & (F.col("d.h") == F.col("w.h")))
        .select("sid", "text"), "class-texts")
    links = materialise(verify(first, texts, n, percent), "leader-links")

    def apart_now(rows: DataFrame) -> DataFrame:
        """The rows with their components, of n-grams that still lie in several; members: size of the component."""
        groups = components(links.filter("linked").select("a", "b"))
        sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
        told = groups.join(sizes, "component").select(F.col("node").alias("sid"), "component", "members")
        placed = materialise(rows.select("gram", "sid", "size", "place").join(told, "sid", "left").select(
            "gram", "sid", "size", "place", F.coalesce("component", "sid").alias("component"),
            F.coalesce("members", F.lit(1)).alias("members")), "placed-grams")
        several = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        return materialise(placed.join(several.select("gram"), "gram", "left_semi"), "grams-apart")

    apart = shared
    for _ in range(MORE_ROUNDS):
        apart = apart_now(apart)
        lead = apart.groupBy("gram").agg(F.max_by(
            F.struct("sid", "size", "place", "component"), F.struct("members", F.xxhash64("gram", "sid"))).alias("l"))
        near = (
            apart.alias("x").join(lead.select("gram", "l.*").alias("y"), "gram")
            .filter(f"x.component <> y.component and if(x.size < y.size, {allowed('x.', 'y.')}, {allowed('y.', 'x.')})")
            .groupBy(F.col("x.sid"), F.col("y.sid").alias("l_sid")).agg(F.count("*").alias("times"))
            .withColumn("place", F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("times"), "l_sid")))
            .filter(f"place <= {LEADERS}")
            .select(F.least("sid", "l_sid").alias("a"), F.greatest("sid", "l_sid").alias("b")).distinct()
            .join(links.select("a", "b"), ["a", "b"], "left_anti")
        )
        links = materialise(links.unionByName(verify(materialise(near, "leader-pairs"), texts, n, percent)), "leader-links")
    apart = apart_now(apart)
    heads = apart.groupBy("sid").agg(F.expr(f"slice(sort_array(collect_list(struct(place, gram))), 1, {HEAD})").alias("head"))
    before = F.expr("transform(filter(head, g -> g.place < place), g -> g.gram)").alias("before")
    apart = apart.join(classes.select("sid", "odd"), "sid").join(heads, "sid").select(*apart.columns, "odd", before)
    second = apart.alias("x").join(apart.alias("y"), F.expr(
        f"x.gram = y.gram and x.component <> y.component and (x.size < y.size or x.size = y.size and x.sid < y.sid) and "
        f"{allowed('x.', 'y.')} and "
        f"{100 + percent} * {fewest_unlike('x.odd', 'y.odd')} <= {100 - percent} * (x.size + y.size) and "
        "not arrays_overlap(x.before, y.before)"))
    second = second.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")).distinct()
    second = second.join(links.select("a", "b"), ["a", "b"], "left_anti")
    more = verify(materialise(second, "prefix-pairs"), texts, n, percent)
    return documents, links.unionByName(materialise(more, "prefix-links")).filter("linked").select("a", "b")


def join_similar(documents: DataFrame, n: int = 4, percent: int = 85, bits: int = 64) -> DataFrame:
    """(doc_id, h, n_shingles, component_id, component): one row per document.

    ``component_id`` is the smallest doc_id linked directly or through others, with
    Jaccard of at least ``percent`` / 100. ``h`` is the hash of the text, for rows that
    share an id. Null ids link like any other; a component of nothing else has a null id,
    so ``component`` tells components apart by number. It is null without n-grams.
    """
    base = documents.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    sets, links = similar_classes(base, n, percent, bits)
    groups = components(links)
    members = sets.filter("sid is not null")
    low = members.groupBy("sid").agg(F.min("doc_id").alias("low"))
    placed = low.join(groups.toDF("sid", "component"), "sid", "left").withColumn(
        "component", F.coalesce("component", "sid"))
    of_component = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = materialise(placed.join(of_component, "component").select("sid", "component_id", "component"), "components")
    names = ["doc_id", "h", "n_shingles", "component_id", "component"]
    return members.join(ids, "sid").select(names).unionByName(
        sets.filter("sid is null").withColumns(
            {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}).select(names))


def one_of_each(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The documents with the smallest id of each component, all columns; those without words all stay."""
    placed = join_similar(documents, n, percent)
    keep = placed.filter("component is not null").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNotNull(), "doc_id", "h")).alias("k"))
    keep = keep.select("k.doc_id", "k.h").unionByName(placed.filter("component is null").select("doc_id", "h"))
    key, copy = unused(documents, "key"), unused(documents, "copy")
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    alike = Window.partitionBy(key).orderBy(key)
    return documents.withColumn(key, document_key()).join(keep.select(key_of("doc_id", "h").alias(key)), key, "left_semi").withColumn(
        copy, F.row_number().over(alike)).filter((F.col(copy) == 1) | wordless).select(documents.columns)
