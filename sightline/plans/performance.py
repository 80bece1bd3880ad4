"""Performance input: measured contacts and visibility per face."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline import constants as c
from sightline.functions.formulas import environment_name, visibility
from sightline.operators.relational import first_per_key, is_in, per_listed_key, update_from
from sightline.session import materialise
from sightline.params import ReleaseParams


def latest_run_per_face(runs: DataFrame) -> DataFrame:
    return first_per_key(runs, ["faceid"], {"vacid": "desc"})


def performance_base(t, p: ReleaseParams, panels: DataFrame) -> DataFrame:
    """Faces of the listed panels with their newest run.

    With ``face_rules`` rotating panels count by their first position only and
    the environment is taken from the panel's subtype.
    """
    all_runs = t.vai_vac_res.select("mid", "faceid", "vacid")
    newest = per_listed_key(
        # one run per panel version and face; of several versions' runs the newest of the face
        all_runs, panels, "mid", lambda r: first_per_key(r, ["mid", "faceid"], {"vacid": "desc"})
    )
    newest = latest_run_per_face(newest)
    main = is_in(t.pnl_main.select("mid", "pid", "pnlsubtype", "pnlmotion"), panels, "mid")
    runs = is_in(t.vai_vac_res.select("vacid", "mid", "faceid", "err_vac_res"), newest, "vacid")
    faces = t.pnl_facemid.select("faceid", "facepid", "face_userid")
    base = main.join(runs, "mid").join(faces, "faceid")
    if p.face_rules:
        positions = t.pnl_faces.select("facepid", "pos")
        kinds = t.code_pnlsubtype.select("pnlsubtype", "pnlvaienv")
        rotating = F.col("pnlmotion") == c.MOTION_ROTATING
        base = (
            base.join(positions, "facepid")
            .join(kinds, "pnlsubtype")
            .filter(~rotating | (rotating & (F.col("pos") == c.MEASURED_POSITION)))
        )
    else:
        base = base.withColumn("pnlvaienv", F.lit(None).cast("string"))
    return base.select(
        "pid", "mid", "facepid", "face_userid", "vacid", F.col("faceid").alias("faceid_db"), "err_vac_res",
        environment_name(F.col("pnlvaienv")).alias("pnlvaienv"),
    )


def transport_pivot(results: DataFrame, period: int, types: tuple[str, ...]) -> DataFrame:
    """One row per run with vac and rots of every transport type, in one pass."""
    picked = results.filter((F.col("periodid") == period) & F.col("transptype").isin(*types))
    values = [
        F.max(F.when(F.col("transptype") == kind, F.col(value))).alias(f"{value}_week_{kind.lower()}")
        for value in ("vac", "rots")
        for kind in types
    ]
    return picked.groupBy("vacid").agg(*values)


def visibility_columns(df: DataFrame, types: tuple[str, ...]) -> DataFrame:
    return df.withColumns({
        f"va_week_{k}": visibility(F.col(f"vac_week_{k}"), F.col(f"rots_week_{k}"), needs_vac=k == "all")
        for k in (kind.lower() for kind in types)
    })


def weekly_scale(df: DataFrame, factor: int, types: tuple[str, ...]) -> DataFrame:
    """Daily values to weekly ones; ratios do not change."""
    return df.withColumns({
        f"{value}_week_{kind.lower()}": F.col(f"{value}_week_{kind.lower()}") * factor
        for value in ("vac", "rots")
        for kind in types
    })


def performance_input(t, p: ReleaseParams, panels: DataFrame) -> DataFrame:
    base = materialise(performance_base(t, p, panels), "performance-base")
    pivot = per_listed_key(
        t.output_round, base, "vacid", lambda r: transport_pivot(r, p.input_period, p.transport_types)
    )
    names = {n: n for n in pivot.columns if n != "vacid"}
    full = visibility_columns(update_from(base, pivot, ["vacid"], names), p.transport_types)
    return weekly_scale(full, p.weekly_factor, p.transport_types) if p.weekly_factor else full
