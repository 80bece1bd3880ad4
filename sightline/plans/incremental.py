"""Daily run over changed, recalculated and repaired panels."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame

from sightline.params import ReleaseParams
from sightline.plans import ccf, contacts, evidence, lifecycle, panels, performance, publish
from sightline.session import materialise


class IncrementalRun:
    """The steps of a daily run; each is computed when first asked for."""

    def __init__(self, t, p: ReleaseParams, load_id: int = 1, queued_at: dt.datetime | None = None):
        self.t, self.p, self.load_id = t, p, load_id
        self.queued_at = queued_at or dt.datetime.combine(p.as_of, dt.time())

    @cached_property
    def changed(self) -> DataFrame:
        return panels.changed_panels(self.t, self.p)

    @cached_property
    def latest(self) -> DataFrame:
        """Of all panel versions: the changed, the recalculated and the repaired ones look theirs up."""
        return panels.latest_results(self.t, self.p)

    @cached_property
    def with_results(self) -> DataFrame:
        changed = materialise(self.changed, "changed")
        return materialise(panels.attach_latest_result(self.t, self.p, changed, self.latest), "results")

    @cached_property
    def recalculation(self) -> lifecycle.Recalculation:
        return lifecycle.recalculation_steps(self.t, self.p, self.with_results, self.queued_at, self.latest)

    @cached_property
    def to_process(self) -> DataFrame:
        return materialise(self.recalculation.panels, "to-process", counted=True)

    @cached_property
    def unpublish_list(self) -> DataFrame:
        return materialise(publish.unpublish_list(self.t, self.p, self.to_process), "unpublish")

    @cached_property
    def after_unpublish(self) -> DataFrame:
        return publish.unpublish(self.p, self.t.release_publish, self.unpublish_list)

    @cached_property
    def version_split(self) -> tuple[DataFrame, DataFrame]:
        return lifecycle.split_map_versions(self.t, self.p, self.to_process, self.t.bad_navteq, self.latest)

    @cached_property
    def panels(self) -> DataFrame:
        return materialise(self.version_split[0], "panels", counted=True)

    @cached_property
    def performance(self) -> DataFrame:
        return materialise(performance.performance_input(self.t, self.p, self.panels), "performance")

    @cached_property
    def intersections(self) -> DataFrame:
        return materialise(evidence.trip_intersections(self.t.trip_routes, self.p, self.panels), "intersections")

    @cached_property
    def typed_panels(self) -> DataFrame:
        return materialise(panels.set_intersection_type(self.panels, self.intersections), "typed")

    @cached_property
    def nearest(self) -> DataFrame:
        """Neighbours come from the pool as it was before this run."""
        return evidence.nearest_panels(self.p, self.typed_panels, self.t.all_panel)

    @cached_property
    def best(self) -> DataFrame:
        return materialise(evidence.best_neighbour(self.nearest), "best")

    @cached_property
    def substitute_intersections(self) -> DataFrame:
        return evidence.substitute_intersections(self.t, self.p, self.best)

    @cached_property
    def evidence(self) -> DataFrame:
        """Two written tables; the intersections are not copied."""
        found = self.intersections.select(*evidence.EVIDENCE_COLUMNS)
        return found.unionByName(materialise(self.substitute_intersections, "borrowed"))

    @cached_property
    def pool(self) -> DataFrame:
        return publish.refresh_pool(self.t.all_panel, self.typed_panels)

    @cached_property
    def weighed(self) -> contacts.Evidence:
        """The evidence with its heavy keys."""
        return contacts.Evidence(self.evidence)

    @cached_property
    def contacts(self) -> DataFrame:
        return contacts.contact_fanout(self.t, self.p, self.weighed)

    @cached_property
    def stats(self) -> DataFrame:
        return materialise(ccf.stats_of(self.t, self.p, self.weighed, self.performance), "stats")

    @cached_property
    def contacts_with_reach(self) -> DataFrame:
        return ccf.contacts_with_reach(self.t, self.p, self.weighed, self.stats)

    @cached_property
    def result(self) -> DataFrame:
        if self.p.use_frequency_vector:
            return ccf.result_rows(self.t, self.p, self.weighed, self.stats, self.panels, self.load_id)
        return ccf.staged_result_rows(self.t, self.p, self.weighed, self.performance, self.load_id)

    @cached_property
    def published(self) -> DataFrame:
        return publish.publish(self.t, self.p, self.after_unpublish, self.performance)
