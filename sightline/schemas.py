"""Input, state and output tables of the pipeline."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PANEL_LIST_COLUMNS = ("mid", "pid", "x", "y", "radius", "maxdist")

INPUTS = {
    "pnl_main": "mid BIGINT, pid BIGINT, maxdist INT, pnlsubtype STRING, pnlmotion STRING, navteqver STRING",
    "pnl_geom": "mid BIGINT, x DOUBLE, y DOUBLE",
    "panel_state": "mid BIGINT, pid BIGINT, stamp TIMESTAMP, status INT, timeattid INT, ownid INT",
    "pnl_timeatts": "pid BIGINT, stamp TIMESTAMP, timeattid INT",
    "pnl_facemid": "mid BIGINT, faceid BIGINT, facepid BIGINT, face_userid STRING",
    "pnl_faces": "facepid BIGINT, pid BIGINT, pos INT",
    "code_pnlsubtype": "pnlsubtype STRING, pnlvaienv STRING",
    "vai_vac_res": "vacid BIGINT, mid BIGINT, faceid BIGINT, err_vac_res STRING",
    "output_round": "vacid BIGINT, periodid INT, transptype STRING, vac DOUBLE, rots DOUBLE",
    "vai_seg": (
        "mid BIGINT, navteqid BIGINT, navteqver STRING, orient STRING, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE"
    ),
    "topo_streets": "link_id BIGINT, navteqver STRING, linetype STRING",
    "trip_routes": (
        "sid BIGINT, respondent_id STRING, routingmode STRING, week_day_name STRING, week_day_type STRING,"
        " trip_freq DOUBLE, geom ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
    ),
    "trip_routes_older": (
        "sid BIGINT, respondent_id STRING, routingmode STRING, week_day_name STRING, week_day_type STRING,"
        " trip_freq DOUBLE, geom ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
    ),
    "resp_weight_input": "respondent_id STRING, benchwgt_pp DECIMAL(10,3)",
    "freq_trips_vector": (
        "weekdaytype STRING, weekdayname STRING, freq_from DOUBLE, freq_to DOUBLE, prob DECIMAL(5,4)"
    ),
}

STATE = {
    "panel_inbox": "pid BIGINT",
    "no_calc": "pid BIGINT, err_vac_res STRING",
    "no_calc_inc": (
        "pid BIGINT, mid BIGINT, err_vac_res STRING, complexity_index DECIMAL(12,3), routing_difficulty STRING,"
        " in_queue BOOLEAN, calculated BOOLEAN, processed BOOLEAN, ignore BOOLEAN"
    ),
    "pnl_to_revise": (
        "pid BIGINT, mid BIGINT, err_vac_res STRING, complexity_index DECIMAL(12,3), routing_difficulty STRING,"
        " load_id BIGINT, va DOUBLE, vac DOUBLE, null_zero_result BOOLEAN"
    ),
    "bad_navteq": "mid BIGINT, pid BIGINT, navteqver STRING, processed INT",
    "vac_queue": (
        "vacid BIGINT, faceid BIGINT, mid BIGINT, usrn STRING, stamp_in_queue TIMESTAMP, stamp_end TIMESTAMP,"
        " priority INT, rmloadid INT, temp_table INT"
    ),
    "all_panel": (
        "mid BIGINT, pid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE, vac_all_1 DOUBLE, maxdist INT,"
        " intersection_type STRING, last_vacid BIGINT, err_vac_res STRING"
    ),
    "release_publish": (
        "rvloadid INT, facepid BIGINT, vacid BIGINT, periodid INT, transptype STRING, vac DOUBLE, rots DOUBLE,"
        " pid BIGINT, mid BIGINT, faceid BIGINT"
    ),
    "loads": "load_id BIGINT, user STRING",
    "loads_inc": "load_id BIGINT, user STRING",
    "load_ledger": "part STRING, load_id BIGINT, rows BIGINT, invalid BIGINT",
    "panel_log": (
        "mid BIGINT, pid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE, load_id BIGINT, desc_text STRING"
    ),
    "ccf_result": (
        "pid BIGINT, mid BIGINT, facepid BIGINT, faceid BIGINT, vacid BIGINT, respondent_id STRING, country STRING,"
        " weekdayname STRING, resp_weight DOUBLE, ts_rots DOUBLE, va DOUBLE, vac DOUBLE, load_id BIGINT"
    ),
    "control_sum": (
        "pid BIGINT, faceid BIGINT, sum_of_ts_rots DOUBLE, sum_of_ts_vac DOUBLE, load_id BIGINT"
    ),
}
STATE["ccf_result_inc"] = STATE["ccf_result"]

ALL = {**INPUTS, **STATE}


@lru_cache(maxsize=None)
def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(ALL[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of ``df`` by name, in the order and types of table ``name``."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema(name).fields
    ])
