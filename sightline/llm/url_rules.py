"""Judging URLs by host and path rules, as a sort-merge range join in DataFrame functions only.

A canonical key turns "starts with" into an interval. A host is written backwards by
labels with a dot after each, ``net.example.www.``; a rule's host covers the keys from
its own up to its own followed by byte FF. Intervals of prefixes are nested or apart. So
each interval end is a boundary that carries the stack of intervals open after it, and
a key's stack is that of the last boundary before it in sorted order: one window.

Hosts are swept first, giving the rule hosts above each host. Then, for each of these,
rule host and path make the key of a second sweep over the rules of that host. All
work is on distinct hosts and paths, so copies of an address cost one.

Sorted blocks are cut at boundaries, and each has its own boundaries only. A block with
many keys (one rule may cover a third of all) is dealt to several windows, which each
get its boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 256
KEYS_PER_WINDOW = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url column; both empty without ``://``."""
    after = F.expr(f"substr({url}, instr({url}, '://') + 3)")
    given = F.coalesce(F.col(url).contains("://"), F.lit(False))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*+)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*+([^?#]*+)", 1)
    return F.when(given, host).otherwise(""), F.when(given, path).otherwise("")


def reversed_host(host: str) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit("."))


def _bytes(column: Column) -> Column:
    return F.encode(column, "UTF-8")


def boundaries(prefixes: DataFrame) -> DataFrame:
    """(at, stack): stack is the list of prefixes open from key ``at`` on, the shortest first.

    ``prefixes`` has one column, prefix, without repeats. Those above a prefix are found
    by equality among its own beginnings, so the work is their length, not their number.
    """
    begun = prefixes.select("prefix", F.explode(F.expr("sequence(1, length(prefix))")).alias("n"))
    above = begun.select("prefix", F.expr("substr(prefix, 1, n)").alias("outer")).join(
        prefixes.withColumnRenamed("prefix", "outer"), "outer")
    stacks = above.groupBy("prefix").agg(F.array_sort(F.collect_list("outer")).alias("stack"))
    opening = stacks.select(_bytes(F.col("prefix")).alias("at"), "stack")
    closing = stacks.select(
        F.concat(_bytes(F.col("prefix")), F.unhex(F.lit("FF"))).alias("at"), F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    return opening.unionByName(closing)


def open_prefixes(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``keys`` (key and other columns) with the stack of prefixes each key starts with; keys without any are left out."""
    bounds = boundaries(prefixes)
    cuts = [r.at for r in bounds.orderBy(F.xxhash64("at"), "at").limit(BLOCKS - 1).select("at").collect()]
    splits = F.array(*[F.unhex(F.lit(bytes(c).hex())) for c in sorted(cuts)]).cast("array<binary>")

    def block(key: Column) -> Column:
        return F.size(F.filter(splits, lambda c: c <= key))

    placed = keys.withColumn("at", _bytes(F.col("key"))).withColumn("block", block(F.col("at")))
    sizes = dict(placed.groupBy("block").count().collect())  # one row for each block
    windows = [1 + sizes.get(b, 0) // KEYS_PER_WINDOW for b in range(BLOCKS)]
    dealt = F.element_at(F.array(*map(F.lit, windows)), F.col("block") + 1)
    own = placed.withColumn("part", F.pmod(F.xxhash64("at"), dealt).cast("int"))
    shared = bounds.withColumn("block", block(F.col("at"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), dealt - 1)))
    both = own.withColumn("is_key", F.lit(1)).unionByName(shared.withColumn("is_key", F.lit(0)), allowMissingColumns=True)
    before = Window.partitionBy("block", "part").orderBy("at", "is_key").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("stack", F.last("stack", True).over(before))
    return swept.filter("is_key = 1 and size(stack) > 0").select(*keys.columns, "stack")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    ``pages`` has page_id and url; ``rules`` has host, path and verdict. A rule fits its
    host and all subdomains where the url's path starts with the rule's. The longest
    rule (host and path together, then host) wins; of equal rules with unlike verdicts
    the last in alphabetic order, so block before allow. Without a rule: ``default``
    and a null rule. A rule with a null or empty host or a null verdict fits nothing; a null path is empty.
    A null url has an empty host and path. Repeated pages are judged each.
    """
    host, path = host_and_path("url")
    base = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    known = (
        rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host <> '' and verdict is not null")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(reversed_host("host").alias("key"), "path", F.struct(
            (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"), "verdict").alias("won"))
    )
    sites = base.select("host", "path").distinct()
    hosts = sites.select("host").distinct().withColumn("key", reversed_host("host"))
    above = open_prefixes(hosts, known.select(F.col("key").alias("prefix")).distinct()).select(
        "host", F.explode("stack").alias("outer"))
    keys = sites.join(above, "host").select("host", "path", F.concat("outer", "path").alias("key"), "outer")
    whole = known.select(F.concat("key", "path").alias("prefix"), F.col("key").alias("outer"), "won")
    nested = open_prefixes(keys, whole.select("prefix").distinct())
    # of one host, the innermost rule; a rule host that is a whole host above another one has keys of its own
    found = nested.select("host", "path", "outer", F.explode("stack").alias("prefix")).join(whole, ["prefix", "outer"])
    best = found.groupBy("host", "path").agg(F.max("won").alias("won"))
    return base.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
