"""Whole runs on stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.params import ReleaseParams
from sightline.plans import publish
from sightline.plans.full import FullRun
from sightline.plans.incremental import IncrementalRun
from sightline.session import materialise, rows_written
from sightline.sources.snapshots import CommitConflict, SnapshotStore, StoredTables, WHOLE, key_part, touched_parts

ATTEMPTS = 3


def _next_load(loads) -> int:
    return publish.next_load_id(loads).first()["load_id"]


def _load_row(store: SnapshotStore, load_id: int, user: str | None):
    """Registered under the session's user, unless another one is named."""
    return store.spark.createDataFrame([(load_id, user or store.spark.sparkContext.sparkUser())], "load_id BIGINT, user STRING")


def _load_part(load_id: int) -> str:
    return f"load{load_id}"


def _again_on_conflict(store: SnapshotStore, run: Callable[[], dict[str, int]]) -> dict[str, int]:
    """A run that another one has overtaken starts anew on the other's state, with the next load id."""
    for attempt in range(ATTEMPTS):
        try:
            return run()
        except CommitConflict:
            if attempt + 1 == ATTEMPTS:
                raise
            store.refresh()
    raise AssertionError


# -- state in parts ---------------------------------------------------------------
def _release_part(release: Column, number: Column) -> Column:
    return F.format_string("r%s-%s", release.cast("string"), number.cast("string"))


def _pool_part(number: Column) -> Column:
    return F.format_string("p%s", number.cast("string"))


def _replace_pool(store: SnapshotStore, out, run: IncrementalRun) -> None:
    """The neighbour pool with the processed panels; only the parts that hold their mids are read and written."""
    numbers = touched_parts("mid", run.typed_panels)
    touched = [f"p{n}" for n in numbers]
    if WHOLE in store.paths.get("all_panel", {}):  # an older store's single part is laid out anew once
        old, touched = store.read("all_panel"), None
    else:
        old = store.read("all_panel", parts=touched)
    out.replace_parts("all_panel", publish.refresh_pool(old, run.typed_panels), _pool_part(key_part("mid")), touched)


def _replace_releases(store: SnapshotStore, out, run: IncrementalRun, processed: bool) -> None:
    """Published rows without the panels taken down, with the new rows of the processed ones.

    Other releases and parts without any of these panels keep their files.
    """
    p = run.p
    changed = [run.unpublish_list, run.performance] if processed else [run.unpublish_list]
    numbers = touched_parts("pid", *changed)
    touched = [f"r{release}-{n}" for release in p.releases for n in numbers]
    if WHOLE in store.paths.get("release_publish", {}):
        old, touched = store.read("release_publish"), None
    elif not numbers:
        return
    else:
        old = store.read("release_publish", parts=touched)
    left = publish.unpublish(p, old, run.unpublish_list)
    rows = publish.publish(run.t, p, left, run.performance) if processed else left
    out.replace_parts("release_publish", rows, _release_part(F.col("rvloadid"), key_part("pid")), touched)


def run_full(store: SnapshotStore, inputs: str, p: ReleaseParams, user: str | None = None) -> dict[str, int]:
    """Recompute all panels. Returns the run's counters; load_id 0 means nothing to do."""
    return _again_on_conflict(store, lambda: _run_full(store, inputs, p, user))


def _run_full(store: SnapshotStore, inputs: str, p: ReleaseParams, user: str | None) -> dict[str, int]:
    t = StoredTables(store, inputs)
    out = store.begin()
    load_id = _next_load(t.loads)
    run = FullRun(t, p, load_id)
    counters = {"load_id": 0, "listed": rows_written(run.with_results)}
    if p.consume_inbox:
        out.replace("panel_inbox", store.spark.createDataFrame([], "pid BIGINT"))
    if counters["listed"]:
        debug = "dbg_" if p.debug_target else ""
        out.append("loads", _load_row(store, load_id, user), _load_part(load_id))
        out.replace("no_calc", run.no_calc)
        out.replace_parts("all_panel", run.typed_panels, _pool_part(key_part("mid")))
        if p.grain == "face":
            out.replace("control_sum", run.control_sums)
        result = f"{debug}ccf_result"
        (out.replace if debug else out.append)(result, run.result, part="all" if debug else _load_part(load_id), as_table="ccf_result")
        out.append(
            f"{debug}panel_log", publish.processed_log(run.panels, load_id), f"full{load_id}", as_table="panel_log"
        )
        counters.update(load_id=load_id, processed=rows_written(run.panels), result_rows=out.rows[result])
    out.commit()
    return counters


def run_incremental(
    store: SnapshotStore, inputs: str, p: ReleaseParams, user: str | None = None, queued_at: dt.datetime | None = None
) -> dict[str, int]:
    """Process what changed, publish it, and carry the daily state forward.

    Panels are taken down even if there is nothing to process.
    """
    return _again_on_conflict(store, lambda: _run_incremental(store, inputs, p, user, queued_at))


def _run_incremental(
    store: SnapshotStore, inputs: str, p: ReleaseParams, user: str | None, queued_at: dt.datetime | None
) -> dict[str, int]:
    t = StoredTables(store, inputs)
    out = store.begin()
    load_id = _next_load(t.loads_inc)
    part = _load_part(load_id)
    run = IncrementalRun(t, p, load_id, queued_at)
    step = run.recalculation

    counters = {"load_id": 0, "listed": rows_written(run.to_process)}
    out.replace("no_calc_inc", step.state)
    out.append("vac_queue", step.new_queue_rows, f"run{out.run_id}")
    out.append("panel_log", publish.unpublished_log(run.unpublish_list), f"unpublish{out.run_id}")
    counters["unpublished"] = out.rows["panel_log"]

    if not counters["listed"]:
        out.replace("pnl_to_revise", step.revise)
        _replace_releases(store, out, run, processed=False)
        out.commit()
        return counters

    out.append("loads_inc", _load_row(store, load_id, user), part)
    out.replace("bad_navteq", run.version_split[1])
    _replace_pool(store, out, run)

    rows = materialise(run.result, "result")
    ledger = Ledger(store, out)
    out.replace("pnl_to_revise", ledger.set_aside(rows, step.revise))
    out.append("ccf_result_inc", publish.quarantine(rows, step.revise)[0], part, as_table="ccf_result")
    ledger.enter(part, load_id, out.rows["ccf_result_inc"])
    counters.update(load_id=load_id, processed=rows_written(run.panels), result_rows=out.rows["ccf_result_inc"])
    ledger.write()
    _replace_releases(store, out, run, processed=True)
    out.append("panel_log", publish.processed_log(run.panels, load_id), f"daily{load_id}")
    out.commit()
    return counters


class Ledger:
    """One row per part of the daily results: its load, rows and invalid rows.

    A part is entered when it is written, and what a run writes is checked before. So a
    daily run over clean history opens no old part; only parts that others have written
    without an entry, or entered with invalid rows, are looked into.
    """

    TABLE = "load_ledger"

    def __init__(self, store: SnapshotStore, out) -> None:
        self.store, self.out = store, out
        self.entries = {r.part: tuple(r) for r in store.read(self.TABLE).collect()}  # a row per load

    def suspects(self) -> list[str]:
        parts = self.store.paths.get("ccf_result_inc", {})
        return sorted(part for part in parts if part not in self.entries or self.entries[part][3])

    def enter(self, part: str, load_id: int, rows: int) -> None:
        self.entries[part] = (part, load_id, rows, 0)

    def set_aside(self, rows: DataFrame, revise: DataFrame) -> DataFrame:
        """The revise list with the invalid rows of this load and of suspect parts; those parts are written without them.

        All are held against the list as it was.
        """
        names = ["pid", "mid", "load_id", "va", "vac"]
        found = rows.select(*names)
        for part in self.suspects():
            old = self.store.read("ccf_result_inc", parts=[part], as_table="ccf_result")
            seen = old.agg(F.count(F.lit(1)).alias("rows"), F.count_if(publish.invalid()).alias("bad"), F.max("load_id").alias("load")).first()
            if seen["bad"]:
                found = found.unionByName(old.filter(publish.invalid()).select(*names))
                self.out.replace("ccf_result_inc", publish.quarantine(old, revise)[0], part, as_table="ccf_result")
            self.enter(part, seen["load"], seen["rows"] - seen["bad"])
        return publish.quarantine(found, revise)[1]

    def write(self) -> None:
        """Entries of the parts there are now."""
        parts = self.out.paths.get("ccf_result_inc", {})
        kept = [self.entries[part] for part in sorted(parts) if part in self.entries]
        self.out.replace(self.TABLE, self.store.spark.createDataFrame(kept, "part STRING, load_id BIGINT, rows BIGINT, invalid BIGINT"))
