"""Which points lie within their own radius of which lines.

Both sides are cut into grid cells and joined on the cell. A point goes to the
grid level whose cell is at least its reach; a line goes to every level in use. Long
segments are cut into pieces no longer than a cell, so a segment takes rows in proportion
to its length. A piece stands in the cell of its middle only, and a point in all cells in which
a piece it meets can have its middle: three or four along each axis whatever its radius. So the
lines, mostly the larger side, are not repeated, and a piece and a point meet once. The exact test
runs on the whole segment.

Before the cut a segment is clipped to the box that the points of a level reach, so one
far-off coordinate does not become billions of pieces. With lon/lat the cells are cubes
along the sphere; there lines are arcs and distances great circles, also across 180
degrees and at the poles. The arc is the shorter way; opposite ends have none and match
by their ends only.

No side is broadcast by hand: Spark broadcasts the point cells when they are
small, and else shuffles on the cell, where adaptive execution splits a cell
that holds much of the data across tasks on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.geometry import EARTH_RADIUS, axes, cell_of, check_metric, chord, dot, minus, segment_within

BASE_CELL_METRES = 512.0
MAX_LEVEL = 20
_PAD = 1e-6  # cell margin against rounding in the cut of long segments


def within_distance_join(
    points: DataFrame,
    lines: DataFrame,
    *,
    point_cols: Sequence[str],
    line_key: Sequence[str],
    line_cols: Sequence[str] = (),
    geom: str = "geom",
    metric: str = "planar",
    base_cell: float = BASE_CELL_METRES,
) -> DataFrame:
    """One row per (point row, line row) within the point's ``radius``.

    ``points`` has x, y and radius; equal point rows each count. ``line_key``
    must tell line rows apart; ``line_cols`` come along.
    """
    check_metric(metric)
    grid = _Grid(metric, base_cell)
    pts = grid.point_cells(points, point_cols)
    segs = grid.segment_cells(lines, [*line_key, *line_cols], geom, grid.reached(points))

    p, s = pts.alias("p"), segs.alias("s")
    place = lambda side, name: [F.col(f"{side}.{name}{i}") for i in range(grid.dims)]
    hit = segment_within(metric, place("p", "p"), place("s", "a"), place("s", "b"), F.col("p.radius"))
    pairs = p.join(s, F.col("p.cell") == F.col("s.cell")).filter(hit)
    # A pair shows up once per piece of the line: keep it once. Duplicates met
    # in one task go before the shuffle.
    identity = [*[f"p.{n}" for n in point_cols], "p.x", "p.y", "p.radius", "p.copies", *[f"s.{n}" for n in line_key]]
    if line_cols:
        once = pairs.groupBy(*identity).agg(*[F.first(f"s.{n}").alias(n) for n in line_cols])
    else:
        once = pairs.select(*identity).distinct()
    repeated = once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*point_cols, *line_key, *line_cols)


class _Grid:
    def __init__(self, metric: str, base: float) -> None:
        self.metric, self.base = metric, base
        self.dims = 2 if metric == "planar" else 3

    def _located(self, points: DataFrame) -> DataFrame:
        """Points with their place p0.., reach and grid level."""
        level = F.ceil(F.log2(F.col("reach") / self.base))
        places = axes(self.metric, F.col("x"), F.col("y"))
        return (
            points.filter("x is not null and y is not null and radius >= 0")
            .withColumns({f"p{i}": c for i, c in enumerate(places)})
            .withColumn("reach", chord(self.metric, F.col("radius")))
            .withColumn("level", F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.coalesce(level, F.lit(0)))).cast("int"))
        )

    def reached(self, points: DataFrame) -> list:
        """For each level in use the box that its points reach; a row per level."""
        box = [f(F.col(f"p{i}") + sign * F.col("reach")).alias(f"{name}{i}")
               for i in range(self.dims) for name, f, sign in (("low", F.min, -1), ("high", F.max, 1))]
        return self._located(points).groupBy("level").agg(*box).collect()

    def _size(self) -> Column:
        return F.lit(self.base) * F.pow(F.lit(2.0), F.col("level"))

    def point_cells(self, points: DataFrame, cols: Sequence[str]) -> DataFrame:
        own = [F.col(f"p{i}") for i in range(self.dims)]
        at = self._located(points).groupBy(*cols, "x", "y", "radius", "reach", "level", *own).agg(
            F.count(F.lit(1)).cast("int").alias("copies")).withColumn("size", self._size())
        half, reach = F.col("size") * (0.5 + _PAD), F.col("reach") + F.col("size") * _PAD
        cells = self._cells(at, [c - reach - half for c in own], [c + reach + half for c in own])
        # without the cells at the corners whose middles are all out of reach
        away = [F.greatest(i * F.col("size") - c - half, c - (i + 1) * F.col("size") - half, F.lit(0.0))
                for i, c in zip(self._index(), own, strict=True)]
        return self._named(cells.filter(dot(away, away) <= reach * reach)).drop("size", "reach", "level")

    def segment_cells(self, lines: DataFrame, cols: Sequence[str], geom: str, reached: Sequence) -> DataFrame:
        g, dims = F.col(geom), range(self.dims)
        starts = F.slice(g, F.lit(1), F.greatest(F.size(g) - 1, F.lit(1)))
        ends = F.when(F.size(g) > 1, F.slice(g, F.lit(2), F.greatest(F.size(g) - 1, F.lit(0)))).otherwise(g)
        seg = lines.filter(F.size(g) > 0).select(*cols, F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("seg"))
        named = {f"{n}{i}": c for n in ("a", "b") for i, c in enumerate(axes(self.metric, F.col(f"seg.{n}.x"), F.col(f"seg.{n}.y")))}
        seg = seg.select(*cols, *[c.alias(n) for n, c in named.items()])
        boxes = F.array(*[F.struct(F.lit(r["level"]).alias("level"), *[F.lit(r[f"{n}{i}"]).alias(f"{n}{i}") for i in dims for n in ("low", "high")])
                          for r in reached])
        if not reached:
            return seg.filter("false").withColumn("cell", F.lit(0).cast("bigint"))
        seg = seg.withColumn("box", F.explode(boxes)).withColumn("level", F.col("box.level")).withColumn("size", self._size())
        a, b = [F.col(f"a{i}") for i in dims], [F.col(f"b{i}") for i in dims]
        step = minus(b, a)
        if self.metric == "planar":
            begin, end = F.lit(0.0), F.lit(1.0)
            for i in dims:  # where the segment is inside the box, widened by half a cell
                low, high = F.col(f"box.low{i}") - F.col("size") / 2 - a[i], F.col(f"box.high{i}") + F.col("size") / 2 - a[i]
                begin = F.greatest(begin, F.when(step[i] != 0, F.least(low / step[i], high / step[i])))
                end = F.least(end, F.when(step[i] != 0, F.greatest(low / step[i], high / step[i])))
                seg = seg.filter((step[i] != 0) | ((low <= 0) & (high >= 0)))
            length = F.greatest(*[F.abs(s) for s in step])
        else:
            begin, end, length = F.lit(0.0), F.lit(1.0), F.sqrt(dot(step, step))
        cut = (
            seg.withColumns({"from": begin, "to": end, "length": length}).filter("from <= to")
            .withColumn("pieces", F.greatest(F.ceil(F.col("length") * (F.col("to") - F.col("from")) / F.col("size")), F.lit(1)))
            .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
        )
        # each step is a projection of its own: one expression for all of it outgrows what the JVM compiles
        share = lambda k: F.col("from") + (F.col("to") - F.col("from")) * (F.col("piece") + k) / F.col("pieces")
        cut = cut.withColumns({"_from": share(0), "_to": share(1)})
        one, two = [F.col(f"_one{i}") for i in dims], [F.col(f"_two{i}") for i in dims]
        cut = cut.withColumns({
            **{f"_one{i}": a[i] + step[i] * F.col("_from") for i in dims}, **{f"_two{i}": a[i] + step[i] * F.col("_to") for i in dims}})
        pad = F.lit(0.0)
        if self.metric != "planar":
            # back to the sphere; the arc rises above the straight piece by at most its square / 4 R
            cut = cut.withColumns({f"_{n}": EARTH_RADIUS / F.sqrt(dot(at, at)) for n, at in (("up_one", one), ("up_two", two))})
            cut = cut.withColumns({
                **{f"_one{i}": one[i] * F.col("_up_one") for i in dims}, **{f"_two{i}": two[i] * F.col("_up_two") for i in dims}})
            cut = cut.withColumn("_pad", dot(minus(two, one), minus(two, one)) / (4 * EARTH_RADIUS))
            pad = F.col("_pad")
        middle = [(u + v) / 2 for u, v in zip(one, two, strict=True)]
        if self.metric == "planar":
            cut = cut.withColumns({f"_i{i}": cell_of(c, F.col("size")) for i, c in enumerate(middle)})
            return self._named(cut).select(*cols, *named, "cell")
        # a piece that is longer than a cell on the sphere takes the cells between, so that all of it is half a cell from one
        half = F.col("size") / 2
        low = [F.least(m, F.least(u, v) - pad + half) for m, u, v in zip(middle, one, two, strict=True)]
        high = [F.greatest(m, F.greatest(u, v) + pad - half) for m, u, v in zip(middle, one, two, strict=True)]
        cells = self._cells(cut.select(*cols, *named, "level", "size", *[c.alias(f"_{n}{i}") for n, at in (("low", low), ("high", high)) for i, c in enumerate(at)]),
                            [F.col(f"_low{i}") for i in dims], [F.col(f"_high{i}") for i in dims])
        return self._named(cells).select(*cols, *named, "cell")

    def _cells(self, df: DataFrame, low: Sequence[Column], high: Sequence[Column]) -> DataFrame:
        """One row per cell of the row's level that the box touches, its place in _i0.."""
        size = F.col("size")
        df = df.withColumns({f"_{n}{i}": cell_of(c, size) for n, at in (("first", low), ("last", high)) for i, c in enumerate(at)})
        for i in range(self.dims):
            df = df.withColumn(f"_i{i}", F.explode(F.sequence(f"_first{i}", f"_last{i}")))
        return df.drop(*[f"_{n}{i}" for n in ("first", "last") for i in range(self.dims)])

    def _index(self) -> list[Column]:
        return [F.col(f"_i{i}") for i in range(self.dims)]

    def _named(self, cells: DataFrame) -> DataFrame:
        return cells.withColumn("cell", _cell_id(F.col("level"), self._index())).drop(*[f"_i{i}" for i in range(self.dims)])


def _cell_id(level: Column, index: Sequence[Column]) -> Column:
    """Level and indexes in one long. Indexes wrap at 2^29 cells, three of them at 2^19; two places
    that then share an id are told apart by the exact test."""
    bits = 29 if len(index) == 2 else 19
    out = F.shiftleft(level.cast("bigint"), 58)
    for n, i in enumerate(reversed(index)):
        out = out.bitwiseOR(F.shiftleft(i.bitwiseAND(F.lit((1 << bits) - 1)), n * bits))
    return out
