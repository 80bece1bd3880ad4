"""The domain tables derived from the test tables by whole-number arithmetic.

Every table reads its whole source. The map is a row of towns, one per 2000
panels and 10000 trips, so the work grows in proportion to the data.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.params import ReleaseParams, full_params, incremental_params
from sightline.session import estimate_by_rows

AS_OF = dt.date(2001, 8, 2)
MAP_VERSION = "25q1"
OLD_MAP_VERSION = "24q4"

TOWN_PANELS = 2000
TOWN_TRIPS = 10000
TOWN_PITCH = 50000
TOWN_SIZE = 40000
TRIP_AREA = 24000

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
WEEKEND = ("Saturday", "Sunday")
BANDS = ((0, 50, "0.25"), (50, 200, "0.50"), (200, 1000, "1.00"))


def full() -> ReleaseParams:
    return full_params(AS_OF, MAP_VERSION)


def incremental() -> ReleaseParams:
    return incremental_params(AS_OF, MAP_VERSION)


def _int_div(a: Column, b: int) -> Column:
    return F.floor(a / b)


def _days_ago(days: Column) -> Column:
    return F.date_sub(F.lit(AS_OF), days.cast("int")).cast("timestamp_ntz")


def _plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"interval {hours} hours")


def lon_lat(x: Column, y: Column) -> tuple[Column, Column]:
    """The map laid over the globe, the first town across 180 degrees: a unit is a hundred-thousandth of a degree."""
    lon = x / 100000 + 179.8
    return F.when(lon > 180, lon - 360).otherwise(lon), y / 100000 + 59


def places_on_globe(df: DataFrame) -> DataFrame:
    lon, lat = lon_lat(F.col("x"), F.col("y"))
    return df.withColumns({"x": lon, "y": lat})


def lines_on_globe(df: DataFrame) -> DataFrame:
    def point(g: Column) -> Column:
        lon, lat = lon_lat(g["x"], g["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return df.withColumn("geom", F.transform("geom", point))


class DriverTables:
    """Domain tables over the parquet files in ``sf_dir``; all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._sources: dict[str, DataFrame] = {}
        estimate_by_rows(spark)

    def _read(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def _part(self) -> DataFrame:
        p = F.col("p_partkey")
        return self._read("part").select(
            p.alias("p"), "p_type", "p_size", "p_brand", (_int_div(p, 2) + 1).alias("pid")
        )

    @cached_property
    def _panel_count(self) -> int:
        return self._read("part").count()

    # -- panels ---------------------------------------------------------------
    @cached_property
    def pnl_main(self) -> DataFrame:
        p = F.col("p")
        motion = F.when(p % 5 == 0, c.MOTION_ROTATING).when(p % 17 == 0, None).otherwise("S")
        version = F.when(p % 11 == 0, OLD_MAP_VERSION).otherwise(MAP_VERSION)
        return self._part.select(
            p.alias("mid"), "pid", (F.col("p_size") * 10).alias("maxdist"), F.col("p_type").alias("pnlsubtype"),
            motion.alias("pnlmotion"), version.alias("navteqver"),
        )

    @cached_property
    def pnl_geom(self) -> DataFrame:
        p = F.col("p")
        x = _int_div(p, TOWN_PANELS) * TOWN_PITCH + (p * 7919) % TOWN_SIZE
        return self._part.select(
            p.alias("mid"), x.cast("double").alias("x"), ((p * 104729) % TOWN_SIZE).cast("double").alias("y")
        )

    @cached_property
    def panel_state(self) -> DataFrame:
        p = F.col("p")
        status = F.when(p % 7 != 0, c.STATUS_ACTIVE).otherwise(1 + _int_div(p, 7) % 4)
        return self._part.select(
            p.alias("mid"), "pid", _plus_hours(_days_ago(p % 10), 12).alias("stamp"), status.cast("int").alias("status"),
            F.when(p % 13 == 0, 1).otherwise(0).alias("timeattid"), (F.col("p_size") + 2).alias("ownid"),
        )

    @cached_property
    def pnl_timeatts(self) -> DataFrame:
        p = F.col("p")
        return self._part.filter("p_size between 40 and 42").select(
            "pid", _plus_hours(_days_ago(p % 4), 12).alias("stamp"), (p % 2).cast("int").alias("timeattid")
        )

    @cached_property
    def _faces(self) -> DataFrame:
        return self._part.select("p", "pid", F.explode(F.array(F.lit(1), F.lit(2))).alias("pos"))

    @cached_property
    def pnl_facemid(self) -> DataFrame:
        face = F.col("p") * 2 + F.col("pos")
        return self._faces.select(
            F.col("p").alias("mid"), face.alias("faceid"), (F.col("pid") * 2 + F.col("pos")).alias("facepid"),
            F.concat(F.lit("F"), face.cast("string")).alias("face_userid"),
        )

    @cached_property
    def pnl_faces(self) -> DataFrame:
        return self._faces.select((F.col("pid") * 2 + F.col("pos")).alias("facepid"), "pid", "pos").distinct()

    @cached_property
    def code_pnlsubtype(self) -> DataFrame:
        kind = F.col("p_type")
        env = F.when(kind.isin("ECONOMY", "STANDARD"), "EA").when(kind == "SMALL", "EB").otherwise("EC")
        return self._part.select(kind.alias("pnlsubtype"), env.alias("pnlvaienv")).distinct()

    # -- visibility results ---------------------------------------------------
    @cached_property
    def vai_vac_res(self) -> DataFrame:
        o = F.col("o_orderkey")
        mid = (o * 31) % self._panel_count
        failed = (F.col("o_orderstatus") == "P") & (o % 6 == 0)
        return self._read("orders").select(
            o.alias("vacid"), mid.alias("mid"), (mid * 2 + 1 + _int_div(o, 3) % 2).alias("faceid"),
            F.when(failed, "E1").alias("err_vac_res"),
        )

    @cached_property
    def output_round(self) -> DataFrame:
        o, line = F.col("o_orderkey"), F.col("l_linenumber")
        totals = self._read("orders").filter(F.month("o_orderdate") != 7).select(
            o.alias("vacid"), F.lit(1).alias("periodid"), F.lit("ALL").alias("transptype"),
            (o % 51).cast("double").alias("vac"),
            F.when(o % 97 == 0, 0.0).otherwise(F.floor("o_totalprice").cast("double")).alias("rots"),
        )
        period = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 200).otherwise(2)
        kind = (
            F.when(line == 2, "VEH").when(line == 3, "PUB").when(line == 4, "PED").when(line == 5, "BIC").otherwise("ALL")
        )
        details = self._read("lineitem").select(
            F.col("l_orderkey").alias("vacid"), period.alias("periodid"), kind.alias("transptype"),
            (F.col("l_quantity") - 1).alias("vac"), F.floor("l_extendedprice").cast("double").alias("rots"),
        ).filter("not (periodid = 1 and transptype = 'ALL')")
        older = self._read("lineitem").select(
            F.col("l_orderkey").alias("vacid"), (10 + line % 2).alias("periodid"), kind.alias("transptype"),
            F.col("l_quantity").alias("vac"), F.floor("l_extendedprice").cast("double").alias("rots"),
        )
        return totals.unionByName(details).unionByName(older).groupBy("vacid", "periodid", "transptype").agg(
            F.max("vac").alias("vac"), F.max("rots").alias("rots")
        )

    # -- streets --------------------------------------------------------------
    @cached_property
    def vai_seg(self) -> DataFrame:
        s, m = F.col("l_suppkey"), 3 + F.col("l_partkey") % 9
        side = (s % 2).cast("double")
        return self._read("lineitem").select(
            F.col("l_partkey").alias("mid"), s.alias("navteqid"), F.lit(MAP_VERSION).alias("navteqver"),
            F.when(F.col("l_linenumber") % 2 == 0, "F").otherwise("T").alias("orient"),
            # ends that differ in the seventh place are one node, and rows of one segment differ in their end
            ((s % m) + (F.col("l_linenumber") % 2) * 0.0000002).alias("x1"), side.alias("y1"),
            ((s + 1) % m + _int_div(F.col("l_linenumber"), 4)).cast("double").alias("x2"), side.alias("y2"),
        )

    @cached_property
    def topo_streets(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self._read("supplier").select(
            s.alias("link_id"), F.lit(MAP_VERSION).alias("navteqver"), (65 + s % 8).cast("string").alias("linetype")
        )

    # -- survey ---------------------------------------------------------------
    @cached_property
    def _respondent(self) -> Column:
        return F.concat(F.upper(F.left("c_mktsegment", F.lit(3))), F.col("c_custkey").cast("string"))

    @cached_property
    def trip_routes(self) -> DataFrame:
        e = F.col("event_id")
        x = (_int_div(e, TOWN_TRIPS) * TOWN_PITCH + (e * 6151) % TRIP_AREA).cast("double")
        y = ((e * 3079) % TOWN_SIZE).cast("double")
        day = F.date_format("ts", "EEEE")

        def point(dx: int, dy: int) -> Column:
            return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

        people = self._read("customer").select("c_custkey", self._respondent.alias("respondent_id"))
        return self._read("events").join(people, F.col("user_id") == F.col("c_custkey")).select(
            e.alias("sid"), "respondent_id", F.col("event_type").alias("routingmode"), day.alias("week_day_name"),
            F.when(day.isin(*WEEKEND), "WE").otherwise("WD").alias("week_day_type"), F.col("value").alias("trip_freq"),
            F.array(point(0, 0), point(400, 300), point(800, -200)).alias("geom"),
        )

    @cached_property
    def trip_routes_older(self) -> DataFrame:
        """The trips as an earlier survey drew them, some steps off."""
        return self.trip_routes.withColumn("geom", F.transform("geom", lambda g: F.struct(
            (g["x"] + 150).alias("x"), (g["y"] - 100).alias("y"))))

    @cached_property
    def resp_weight_input(self) -> DataFrame:
        thousandths = F.floor("c_acctbal").cast("decimal(10,0)")
        return self._read("customer").filter("c_acctbal > 0").select(
            self._respondent.alias("respondent_id"), (thousandths / 1000).cast("decimal(10,3)").alias("benchwgt_pp")
        )

    @cached_property
    def freq_trips_vector(self) -> DataFrame:
        days = [("WD", d) for d in WEEKDAYS] + [("WE", d) for d in WEEKEND]
        rows = ", ".join(
            f"('{kind}', '{day}', {lo}D, {hi}D, {prob}BD)" for kind, day in days for lo, hi, prob in BANDS
        )
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} AS v(weekdaytype, weekdayname, freq_from, freq_to, prob)"
        )

    # -- state of earlier runs ------------------------------------------------
    @cached_property
    def panel_inbox(self) -> DataFrame:
        return self._part.filter("p_brand = 'Brand#13' and p_size <= 12").select("pid").distinct()

    @cached_property
    def no_calc(self) -> DataFrame:
        return self._part.filter("p_brand = 'Brand#21' and p_size <= 20").select("pid", F.lit("E0").alias("err_vac_res"))

    @cached_property
    def no_calc_inc(self) -> DataFrame:
        p = F.col("p")
        return self._part.filter("p_size between 5 and 8").select(
            "pid", p.alias("mid"), F.when(p % 2 == 1, "E1").alias("err_vac_res"),
            F.lit(None).cast("decimal(12,3)").alias("complexity_index"),
            F.lit(None).cast("string").alias("routing_difficulty"),
            (p % 5 < 3).alias("in_queue"), (p % 5 == 0).alias("calculated"),
            ((p % 5 == 0) & (_int_div(p, 5) % 2 == 1)).alias("processed"), (p % 7 == 1).alias("ignore"),
        )

    @cached_property
    def vac_queue(self) -> DataFrame:
        p = F.col("p")
        queued = _days_ago(p % 8)
        return self._part.filter("p_size between 5 and 16").select(
            F.lit(0).cast("bigint").alias("vacid"), (p * 2 + 1).alias("faceid"), p.alias("mid"),
            F.lit(c.QUEUE_USER).alias("usrn"), queued.alias("stamp_in_queue"),
            F.when(p % 5 != 2, _plus_hours(queued, 1)).alias("stamp_end"),
            F.lit(1).alias("priority"), F.lit(0).alias("rmloadid"),
            F.when(p % 2 == 0, c.QUEUE_TAG).otherwise(c.LEGACY_QUEUE_TAG).alias("temp_table"),
        )

    @cached_property
    def bad_navteq(self) -> DataFrame:
        p = F.col("p")
        return self._part.filter("p_size in (21, 22)").select(
            p.alias("mid"), "pid", F.lit(OLD_MAP_VERSION).alias("navteqver"),
            F.when(p % 3 == 0, 1).otherwise(0).alias("processed"),
        )

    @cached_property
    def pnl_to_revise(self) -> DataFrame:
        p = F.col("p")
        return self._part.filter("p_size = 33").select(
            "pid", p.alias("mid"), F.lit(None).cast("string").alias("err_vac_res"),
            F.lit(None).cast("decimal(12,3)").alias("complexity_index"),
            F.lit(None).cast("string").alias("routing_difficulty"),
            F.when(p % 2 == 0, 1).cast("bigint").alias("load_id"), F.lit(None).cast("double").alias("va"),
            F.lit(None).cast("double").alias("vac"), F.lit(False).alias("null_zero_result"),
        )

    @cached_property
    def all_panel(self) -> DataFrame:
        """Neighbour pool of the last full run: the active panels of two kinds."""
        margin = full().buffer_margin
        active = self.panel_state.filter("status = 3 and timeattid = 0").select("mid")
        return (
            self.pnl_main.filter("pnlsubtype in ('ECONOMY', 'SMALL')").join(active, "mid", "left_semi").join(self.pnl_geom, "mid").select(
                "mid", "pid", "x", "y", (F.col("maxdist") + margin).alias("radius"),
                (1 + F.col("mid") % 40).cast("double").alias("vac_all_1"), "maxdist",
                F.when(F.col("x") % TOWN_PITCH < TRIP_AREA, c.ORIGINAL).otherwise(c.SUBSTITUTE).alias("intersection_type"),
                F.col("mid").alias("last_vacid"), F.lit(None).cast("string").alias("err_vac_res"),
            )
        )

    @cached_property
    def release_publish(self) -> DataFrame:
        panels = self._part.filter("p_type in ('LARGE', 'PROMO', 'SMALL')").select(F.col("p").alias("mid"), "pid")
        period = F.col("periodid")
        older = (period == 2) & (F.col("transptype") != "BIC")
        release = F.when(period == 1, 100).when(period == 200, 101).when(older, 104).when(period.isin(10, 11), 105).otherwise(99)
        return (
            self.output_round.join(self.vai_vac_res.select("vacid", "mid", "faceid"), "vacid")
            .join(panels, "mid").join(self.pnl_facemid.select("faceid", "facepid"), "faceid")
            .select(
                release.alias("rvloadid"), "facepid", "vacid", "periodid", "transptype", "vac", "rots", "pid", "mid",
                "faceid",
            )
        )

    @cached_property
    def loads(self) -> DataFrame:
        """One earlier load per order month."""
        month = F.date_format("o_orderdate", "yyyyMM").cast("bigint")
        return self._read("orders").select(month.alias("load_id"), F.lit("release").alias("user")).distinct()
