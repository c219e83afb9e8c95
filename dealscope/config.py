"""Parameters of the views: what the business calendar is, and who is looked at."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class SalesConfig:
    """Settings shared by all views.

    ``as_of`` is the local business date the "last three weeks" and "last six months"
    end on. It is a literal in every plan, so date filters prune at planning time.
    """

    as_of: date
    zone: str = "America/Montevideo"
    first_month: date = date(2025, 3, 1)
    cohort_months: int = 6
    weeks: int = 3
    owner_allow_list: tuple[str, ...] = ()
    # "local": half-open local months. "shifted": months moved against the zone offset
    # and closed at second 59, as older dashboards cut them.
    month_bounds: str = "local"
    # True: keep only events whose UTC partition date is inside the weeks as well.
    strict_dt: bool = False
    # True: win rate as whole-number division.
    integer_rate: bool = False
    # True: cohort percent rounded to one decimal first, then to a whole number, as older
    # dashboards did.
    stepwise_percent: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.as_of, datetime):
            raise TypeError("as_of is a local date, not a timestamp")
        if self.month_bounds not in ("local", "shifted"):
            raise ValueError(f"unknown month_bounds {self.month_bounds!r}")

    @classmethod
    def today(cls, zone: str = "America/Montevideo", **settings) -> SalesConfig:
        """Configuration ending on the current date of ``zone``."""
        return cls(as_of=datetime.now(ZoneInfo(zone)).date(), zone=zone, **settings)
