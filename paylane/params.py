"""Arguments of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

MODES = ("DELTA", "DELTAMONTH", "FULL", "REGEN", "FULLACTIVE")
ALL = "ALL"


def parse_day(value: str | datetime) -> datetime:
    """``DD/MM/YYYY`` with an optional ``HH:MM:SS``; a bare date is midnight."""
    if isinstance(value, datetime):
        return value
    pattern = "%d/%m/%Y %H:%M:%S" if ":" in value else "%d/%m/%Y"
    return datetime.strptime(value.strip(), pattern)


@dataclass(frozen=True)
class RunParams:
    """Run window ``[start, end)`` plus the look-back lengths, in days."""

    institute: str
    mode: str
    start: datetime
    end: datetime
    msisdn: str = ALL
    ledger_days: int = 1
    active_days: int = 90
    dormant_days: int = 91
    activity_days: int = 30

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {', '.join(MODES)}")

    @classmethod
    def resolve(
        cls,
        institute: str,
        mode: str,
        end: str | datetime | None = None,
        start: str | datetime | None = None,
        **lengths,
    ) -> "RunParams":
        """End defaults to today at midnight; start to the day before, for the two modes that run daily."""
        mode = mode.upper()
        last = parse_day(end) if end else datetime.combine(datetime.today().date(), datetime.min.time())
        if start:
            first = parse_day(start)
        elif mode in ("DELTA", "FULLACTIVE"):
            first = last - timedelta(days=1)
        else:
            raise ValueError(f"mode {mode} needs a start date")
        return cls(institute=institute, mode=mode, start=first, end=last, **lengths)

    @property
    def ledger_start(self) -> datetime:
        return self.end - timedelta(days=self.ledger_days)

    @property
    def label(self) -> str:
        """Name of the run's output: institute and end date for a full run, start date otherwise."""
        day = self.end if self.mode == "FULL" else self.start
        return f"{self.institute}_{day:%Y%m%d}"
