"""Time bounds: ``earliest`` / ``latest`` modifiers resolved against an explicit ``now``.

Accepted forms (resolved on the driver to one literal, so Catalyst can fold it
and push the bound into the scan):

* ``None`` or blank: no bound;
* ``now``;
* a relative modifier ``[+|-N unit][@snap]``, e.g. ``-1d@d`` (start of
  yesterday), ``@d`` (start of today), ``-15m``, ``-2h@h``, ``@mon``;
* an ISO date / timestamp (``2024-01-15``, ``2024-01-15T12:00:00``);
* epoch seconds (``1705312800``).
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from zoneinfo import ZoneInfo

# The default search window (start of yesterday to start of today)
# and the relative-time unit names.
DEFAULT_EARLIEST = "-1d@d"
DEFAULT_LATEST = "@d"

_UNITS = {
    "s": "s", "sec": "s", "secs": "s", "second": "s", "seconds": "s",
    "m": "m", "min": "m", "mins": "m", "minute": "m", "minutes": "m",
    "h": "h", "hr": "h", "hrs": "h", "hour": "h", "hours": "h",
    "d": "d", "day": "d", "days": "d",
    "w": "w", "week": "w", "weeks": "w",
    "mon": "mon", "month": "mon", "months": "mon",
    "y": "y", "yr": "y", "yrs": "y", "year": "y", "years": "y",
}

_RELATIVE = re.compile(r"^(?:(?P<sign>[+-])(?P<n>\d*)(?P<unit>[a-z]+))?(?:@(?P<snap>[a-z]+))?$")


def _add_months(t: dt.datetime, months: int) -> dt.datetime:
    y, m = divmod(t.month - 1 + months, 12)
    y += t.year
    day = min(t.day, calendar.monthrange(y, m + 1)[1])
    return t.replace(year=y, month=m + 1, day=day)


def _shift(t: dt.datetime, n: int, unit: str, zone: str = "UTC") -> dt.datetime:
    if unit in ("s", "m", "h"):  # elapsed time, also across a clock change
        step = dt.timedelta(seconds=n * {"s": 1, "m": 60, "h": 3600}[unit])
        return _wall(t.replace(tzinfo=ZoneInfo(zone)).astimezone(dt.UTC) + step, zone)
    if unit == "d":
        return t + dt.timedelta(days=n)
    if unit == "w":
        return t + dt.timedelta(weeks=n)
    if unit == "mon":
        return _add_months(t, n)
    return _add_months(t, 12 * n)


def _snap(t: dt.datetime, unit: str) -> dt.datetime:
    if unit == "s":
        return t.replace(microsecond=0)
    if unit == "m":
        return t.replace(second=0, microsecond=0)
    if unit == "h":
        return t.replace(minute=0, second=0, microsecond=0)
    if unit == "d":
        return t.replace(hour=0, minute=0, second=0, microsecond=0)
    if unit == "w":  # week starts on Monday, as Spark's date_trunc('week')
        d = t.replace(hour=0, minute=0, second=0, microsecond=0)
        return d - dt.timedelta(days=d.weekday())
    if unit == "mon":
        return t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return t.replace(month=1, day=1, hour=0, minute=0, second=0, microsecond=0)


def _wall(t: dt.datetime, zone: str) -> dt.datetime:
    """Naive wall-clock time in ``zone``; naive input is taken as already there."""
    return t.astimezone(ZoneInfo(zone)).replace(tzinfo=None) if t.tzinfo else t


def now_in(zone: str = "UTC") -> dt.datetime:
    """The current wall-clock time in ``zone`` (naive)."""
    return dt.datetime.now(ZoneInfo(zone)).replace(tzinfo=None)


def resolve_time(spec: str | dt.datetime | None, now: dt.datetime | str, zone: str = "UTC") -> dt.datetime | None:
    """Resolve one time modifier to a naive wall-clock datetime in ``zone`` (the
    session time zone). Naive inputs are wall-clock times in that zone; times with
    an offset and epoch seconds are converted to it."""
    if spec is None:
        return None
    if isinstance(spec, dt.datetime):
        return _wall(spec, zone)
    s = str(spec).strip()
    if not s:
        return None
    now_t = _wall(dt.datetime.fromisoformat(now) if isinstance(now, str) else now, zone)
    if s.lower() == "now":
        return now_t
    if re.fullmatch(r"\d{9,11}(\.\d+)?", s):
        return _wall(dt.datetime.fromtimestamp(float(s), dt.timezone.utc), zone)
    m = _RELATIVE.match(s.lower())
    if m and (m.group("unit") or m.group("snap")):
        t = now_t
        if m.group("unit"):
            unit = _UNITS.get(m.group("unit"))
            if unit is None:
                raise ValueError(f"unknown time unit in {spec!r}")
            n = int(m.group("n") or 1)
            t = _shift(t, -n if m.group("sign") == "-" else n, unit, zone)
        if m.group("snap"):
            unit = _UNITS.get(m.group("snap"))
            if unit is None:
                raise ValueError(f"unknown snap unit in {spec!r}")
            t = _snap(t, unit)
        return t
    try:
        return _wall(dt.datetime.fromisoformat(s), zone)
    except ValueError:
        raise ValueError(f"cannot read time modifier {spec!r}") from None
