"""One description of a dataset of series: keys, time, target, lags, windows, capabilities."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesSpec:
    keys: tuple[str, ...] = ("product_id", "store_id")
    time: str = "hour_timestamp"
    target: str = "sales_quantity"
    lags: tuple[int, ...] = (1, 24, 48, 168)
    windows: tuple[int, ...] = (24, 168)
    base_lag: int = 1
    unit: str = "hour"
    measures: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    has_stockout: bool = False
    has_weather: bool = False
    has_price: bool = False
    has_behavior: bool = False
    axis: tuple[int, int] | None = None
    categorical: tuple[str, ...] = field(default=())

    def problems(self) -> list[str]:
        """What is wrong with the description; empty if nothing is."""
        out = []
        if not self.keys:
            out.append("keys: at least one is needed")
        if self.time in self.keys or self.target in self.keys or self.target == self.time:
            out.append("keys, time and target must differ")
        if any(k < 1 for k in self.lags):
            out.append("lags: each must be 1 or more")
        if any(n < 2 for n in self.windows):
            out.append("windows: each must be 2 or more")
        if self.unit not in ("hour", "week"):
            out.append("unit: hour or week")
        if self.axis and self.axis[0] > self.axis[1]:
            out.append("axis: from must not exceed to")
        return out

    def check(self) -> SeriesSpec:
        if found := self.problems():
            raise ValueError("; ".join(found))
        return self


HOURLY = SeriesSpec(flags=("is_stockout",), has_stockout=True, has_weather=True)
WEEKLY = SeriesSpec(
    time="week_no",
    target="sales_value",
    lags=(1, 4, 8, 12),
    windows=(4, 8, 12),
    unit="week",
    measures=("quantity", "retail_disc", "coupon_disc"),
    has_price=True,
    has_behavior=True,
    categorical=("department",),
)
