"""Value objects that say which columns form a panel and which days matter.

They are built and checked on the driver, so a wrong argument fails before any
Spark job starts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

# Names the library itself adds to frames; panel columns may not use them.
RESERVED = {"model", "metric", "split", "prediction", "start", "ys", "n_train"}


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns: ``keys`` name a series, ``time`` its day, ``value`` its number.

    ``step_days`` is the distance between two neighbouring points of a series.
    """

    keys: tuple[str, ...]
    time: str
    value: str
    step_days: int = 1

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(self.keys))
        names = [*self.keys, self.time, self.value]
        if not self.keys:
            raise ValueError("a panel needs at least one key column")
        if len(set(names)) != len(names):
            raise ValueError(f"key, time and value columns must differ: {names}")
        if clash := RESERVED.intersection(names):
            raise ValueError(f"column names reserved for results: {sorted(clash)}")
        positive("step_days", self.step_days)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.time, self.value]


@dataclass(frozen=True)
class Cutoffs:
    """Days that bound a run, all derived from one execution date.

    Facts count when ``start <= day <= end``; days after ``train_end`` are test
    days. ``window`` and ``test_size`` count steps, while ``end`` is always the
    day before the execution date.
    """

    execution_date: date
    window: int = 728
    test_size: int = 21
    step_days: int = 1

    def __post_init__(self) -> None:
        positive("window", self.window)
        positive("test_size", self.test_size)
        positive("step_days", self.step_days)
        if self.test_size >= self.window:
            raise ValueError("test_size must be smaller than window")

    @property
    def start(self) -> date:
        return self.execution_date - timedelta(days=self.window * self.step_days)

    @property
    def end(self) -> date:
        return self.execution_date - timedelta(days=1)

    @property
    def train_end(self) -> date:
        return self.end - timedelta(days=self.test_size * self.step_days)


def positive(name: str, number: int) -> int:
    if isinstance(number, bool) or not isinstance(number, int) or number < 1:
        raise ValueError(f"{name} must be a whole number above 0, got {number!r}")
    return number


def today_in(tz: str, now: datetime | None = None) -> date:
    """The calendar day in time zone ``tz``: the default execution date.

    ``now`` must carry a time zone; it is an argument so that tests can fix it.
    """
    now = now or datetime.now(tz=ZoneInfo("UTC"))
    if now.tzinfo is None:
        raise ValueError("now must be time-zone aware")
    return now.astimezone(ZoneInfo(tz)).date()
