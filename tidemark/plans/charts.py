"""Chart descriptions as JSON, from small results."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame

# Kinds, units and scales that a chart may name.
KINDS = ("line", "bar", "stacked-bar", "stacked-bar-100", "area", "stacked-area-100", "pie", "scatter", "heatmap", "treemap")
UNITS = ("percent", "dollars", "cents", "number", "bytes", "hours", "days")
MOST_ROWS = 10_000


@dataclass
class Chart:
    """What to draw; unset parts are left out of the JSON."""

    type: str
    data: list[dict[str, Any]]
    x: str | None = None
    y: list[str] | None = None
    title: str | None = None
    unit: str | None = None
    scale: str | None = None
    extra: dict[str, Any] | None = field(default=None)

    def __post_init__(self) -> None:
        if self.type not in KINDS:
            raise ValueError(f"no such chart: {self.type}")
        if self.unit is not None and self.unit not in UNITS:
            raise ValueError(f"no such unit: {self.unit}")

    def to_dict(self) -> dict[str, Any]:
        return {k: v for k, v in asdict(self).items() if v is not None}

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), default=str)


def chart_of(rows: DataFrame, kind: str, x: str, y: list[str], places: int = 2, **more: Any) -> Chart:
    """A chart of a small result: rows by x, numbers rounded, missing ones 0."""
    small = rows.select(x, *y).orderBy(x).limit(MOST_ROWS + 1).collect()
    if len(small) > MOST_ROWS:
        raise ValueError("too many rows for a chart")
    data = [{x: r[x], **{c: round(r[c] or 0, places) for c in y}} for r in small]
    return Chart(kind, data, x, y, **more)
