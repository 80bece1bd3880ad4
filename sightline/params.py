"""Run parameters. Older behaviour is a set of parameter values, not other code."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from sightline import constants as c


@dataclass(frozen=True)
class ReleaseParams:
    as_of: dt.date
    map_version: str

    # panel list
    buffer_margin: float = 200.0
    owner_exception: int | None = None
    consume_inbox: bool = True

    # latest result of a panel
    vac_period: int = 1

    # trips and neighbours
    metric: str = "planar"  # of neighbour distances: planar | metres
    buffer_metric: str = "planar"  # of buffers: planar (x, y in metres) | metres (lon, lat)
    neighbour_count: int = 20
    neighbour_radius: float | None = 5000.0
    exclude_self: bool = False

    # performance input
    input_period: int = 1
    transport_types: tuple[str, ...] = c.TRANSPORT_TYPES
    face_rules: bool = True  # subtype join and rotating-panel rule
    weekly_factor: int | None = None

    # contacts
    vector_key: tuple[str, ...] = ("week_day_type",)
    use_frequency_vector: bool = True
    weekday_prefix: int | None = None
    numbered_panels_only: bool = False  # of the staged form: panels with a pid
    substitute_trips: str = "trip_routes"  # trips a daily run matches with borrowed buffers

    # contact formula
    grain: str = "face"  # face | panel
    whole_frequency: bool = True
    frequency_cap: float = 100.0
    clamp: bool = True
    vac_weight: str = "ts_rots"  # ts_rots | respweight
    distinct_result: bool = False

    # daily state
    queue_tag: int = c.QUEUE_TAG
    queue_days: int = 4
    exclude_line_types: tuple[str, ...] = ()
    refresh_errors_first: bool = True
    late_panels_get_vac: bool = True

    # publishing
    ids_release: int = 100
    ids_period: int = 1
    ims_release: int = 101
    ims_periods: tuple[int, ...] = (200,)

    # where results go
    debug_target: bool = False

    @property
    def releases(self) -> tuple[int, int]:
        return (self.ids_release, self.ims_release)

    def with_(self, **changes) -> "ReleaseParams":
        return replace(self, **changes)


def full_params(as_of: dt.date, map_version: str, **changes) -> ReleaseParams:
    """Full recompute, statistics per face."""
    return ReleaseParams(as_of, map_version).with_(**changes)


def incremental_params(as_of: dt.date, map_version: str, **changes) -> ReleaseParams:
    """Daily run, statistics per panel."""
    return ReleaseParams(
        as_of,
        map_version,
        consume_inbox=False,
        vector_key=("week_day_type", "week_day_name"),
        grain="panel",
        whole_frequency=False,
        frequency_cap=20.0,
        clamp=False,
        vac_weight="respweight",
        distinct_result=True,
    ).with_(**changes)


_LEGACY = dict(
    neighbour_radius=None,
    input_period=2,
    transport_types=c.LEGACY_TRANSPORT_TYPES,
    face_rules=False,
    weekly_factor=7,
    use_frequency_vector=False,
    weekday_prefix=2,
    grain="panel",
    whole_frequency=False,
    frequency_cap=20.0,
    clamp=False,
    vac_weight="respweight",
    distinct_result=False,
)


def legacy_full_params(as_of: dt.date, map_version: str, **changes) -> ReleaseParams:
    """Older full recompute: no frequency vector, weekly = daily x 7."""
    return ReleaseParams(as_of, map_version).with_(**{**_LEGACY, "numbered_panels_only": True, **changes})


def legacy_incremental_params(as_of: dt.date, map_version: str, **changes) -> ReleaseParams:
    """Older daily run: owner exception, line types left out, other periods, trips and releases."""
    values = dict(
        _LEGACY,
        consume_inbox=False,
        owner_exception=51,
        vac_period=2,
        queue_tag=c.LEGACY_QUEUE_TAG,
        exclude_line_types=c.LEGACY_EXCLUDED_LINE_TYPES,
        substitute_trips="trip_routes_older",
        ids_release=104,
        ids_period=2,
        ims_release=105,
        ims_periods=(10, 11),
    )
    return ReleaseParams(as_of, map_version).with_(**{**values, **changes})
