"""Full recompute over all standing panels."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from sightline.params import ReleaseParams
from sightline.plans import ccf, contacts, evidence, panels, performance
from sightline.session import materialise


class FullRun:
    """The steps of a full recompute; each is computed when first asked for.

    Results with several consumers are written once, all else stays lazy.
    """

    def __init__(self, t, p: ReleaseParams, load_id: int = 1):
        self.t, self.p, self.load_id = t, p, load_id

    @cached_property
    def listed(self) -> DataFrame:
        return panels.panel_list_full(self.t, self.p)

    @cached_property
    def with_results(self) -> DataFrame:
        return materialise(
            panels.attach_latest_result(self.t, self.p, materialise(self.listed, "listed")), "results", counted=True
        )

    @cached_property
    def no_calc_split(self) -> tuple[DataFrame, DataFrame]:
        return panels.split_not_calculated(self.with_results, self.t.no_calc)

    @cached_property
    def no_calc(self) -> DataFrame:
        return self.no_calc_split[0]

    @cached_property
    def panels(self) -> DataFrame:
        return materialise(self.no_calc_split[1], "panels", counted=True)

    @cached_property
    def performance(self) -> DataFrame:
        return performance.performance_input(self.t, self.p, self.panels)

    @cached_property
    def intersections(self) -> DataFrame:
        return materialise(evidence.trip_intersections(self.t.trip_routes, self.p, self.panels), "intersections")

    @cached_property
    def typed_panels(self) -> DataFrame:
        return materialise(panels.set_intersection_type(self.panels, self.intersections), "typed")

    @cached_property
    def nearest(self) -> DataFrame:
        return evidence.nearest_panels(self.p, self.typed_panels, self.typed_panels)

    @cached_property
    def best(self) -> DataFrame:
        return materialise(evidence.best_neighbour(self.nearest), "best")

    @cached_property
    def borrowed(self) -> DataFrame:
        return evidence.borrowed_evidence(self.best, self.intersections)

    @cached_property
    def evidence(self) -> DataFrame:
        """Two written tables; the intersections are not copied."""
        found = self.intersections.select(*evidence.EVIDENCE_COLUMNS)
        return found.unionByName(materialise(self.borrowed, "borrowed"))

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
    def control_sums(self) -> DataFrame:
        return ccf.control_sums(self.t, self.p, self.weighed, self.stats, self.load_id)

    @cached_property
    def result(self) -> DataFrame:
        if self.p.use_frequency_vector:
            return ccf.result_rows(self.t, self.p, self.weighed, self.stats, self.panels, self.load_id)
        return ccf.staged_result_rows(self.t, self.p, self.weighed, self.performance, self.load_id)
