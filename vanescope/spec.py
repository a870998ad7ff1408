"""Description of a series of readings; every operator takes its column names from it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesSpec:
    """Columns and limits of one kind of reading.

    keys       columns that name the sensor
    ts         event time; (keys, ts) should occur once
    measures   measured columns, the ones cleaned and cast
    target     the measure that is summarised and searched for anomalies
    bounds     inclusive valid range per measure; anything outside becomes NULL
    tie_break  columns that choose between duplicates, before all the others
    decimal    (precision, scale) of the cleaned measures
    label      suffix of the statistics columns, e.g. ``avg_<label>``
    unit       suffix of the bound columns, e.g. ``lower_bound_<unit>``
    """

    keys: tuple[str, ...]
    ts: str
    measures: tuple[str, ...]
    target: str
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    tie_break: tuple[str, ...] = ()
    decimal: tuple[int, int] = (10, 4)
    label: str = ""
    unit: str = ""

    def __post_init__(self) -> None:
        if self.target not in self.measures:
            raise ValueError(f"target {self.target!r} is not one of {self.measures}")
        unknown = set(self.bounds) - set(self.measures)
        if unknown:
            raise ValueError(f"bounds for columns that are no measures: {sorted(unknown)}")
        object.__setattr__(self, "label", self.label or self.target)
        object.__setattr__(self, "unit", self.unit or self.label)

    @property
    def reading_keys(self) -> tuple[str, ...]:
        return (*self.keys, self.ts)


# Column names and operating limits of the turbine readings.
TURBINE = SeriesSpec(
    keys=("turbine_id",),
    ts="timestamp",
    measures=("wind_speed", "wind_direction", "power_output"),
    target="power_output",
    bounds={
        "wind_speed": (0.0, 25.0),
        "wind_direction": (0.0, 360.0),
        "power_output": (0.0, 2.5),
    },
    label="power_mw",
    unit="mw",
)
