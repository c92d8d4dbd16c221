"""Report times: epoch seconds, zone-less UTC text, timestamps, calendar parts and hour ranges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def epoch_to_iso(epoch: Column) -> Column:
    """Epoch seconds to UTC text; fractions of a second are cut off."""
    return F.date_format(F.timestamp_seconds(F.floor(epoch)), ISO_SECONDS)


def report_epoch(number: Column) -> Column:
    """A report's epoch slot; zero counts as missing."""
    return F.nullif(number.try_cast("double"), F.lit(0.0))


def parse_time(text: Column) -> Column:
    """UTC text to timestamp; malformed text becomes null and the row is kept."""
    return F.try_to_timestamp(text)


def calendar_parts(ts: Column, names: Sequence[str]) -> list[Column]:
    """Year, month, day and hour of ``ts`` as ints under the given four names."""
    parts = (F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts))
    return [part.alias(name) for part, name in zip(parts, names, strict=True)]


def padded_calendar_parts(ts: Column, names: Sequence[str]) -> list[Column]:
    """As ``calendar_parts`` but zero-padded text, the form of bronze directory names."""
    return [F.date_format(ts, f).alias(n) for f, n in zip(("yyyy", "MM", "dd", "HH"), names, strict=True)]


def as_utc(moment: datetime | str | None) -> datetime:
    """A zone-aware UTC datetime; zone-less input means UTC and None means now."""
    if moment is None:
        return datetime.now(timezone.utc)
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def floor_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)


def floor_day(moment: datetime) -> datetime:
    return floor_hour(moment).replace(hour=0)


@dataclass(frozen=True)
class HourRange:
    """Whole hours from ``start`` up to, not including, ``end``; both on the hour, in UTC."""

    start: datetime
    end: datetime

    @classmethod
    def covering(cls, as_of: datetime, lookback: timedelta) -> HourRange:
        """From the hour of ``as_of - lookback`` through the hour of ``as_of``."""
        return cls(floor_hour(as_of - lookback), floor_hour(as_of) + HOUR)

    @classmethod
    def around(cls, hours: Iterable[datetime], after: timedelta, gap: timedelta = DAY) -> list[HourRange]:
        """Ranges, in order, that hold ``hours`` and ``after`` past each; those less than ``gap`` apart become one."""
        found: list[HourRange] = []
        for begin in sorted(hours):
            whole = cls(begin, begin + HOUR).widened(after=after)
            if found and whole.start - found[-1].end < gap:
                found[-1] = cls(found[-1].start, max(found[-1].end, whole.end))
            else:
                found.append(whole)
        return found

    def widened(self, before: timedelta = timedelta(0), after: timedelta = timedelta(0)) -> HourRange:
        end = self.end + after
        whole = floor_hour(end)
        return HourRange(floor_hour(self.start - before), whole if whole == end else whole + HOUR)

    def whole_days(self) -> HourRange:
        end = floor_day(self.end)
        return HourRange(floor_day(self.start), end if end == self.end else end + DAY)

    def steps(self) -> Iterator[tuple[datetime, int]]:
        """The range as the largest calendar units it covers whole: 1 for a year, 2 a month, 3 a day, 4 an hour."""
        at = self.start
        while at < self.end:
            day = floor_day(at)
            units = (
                (1, day.replace(month=1, day=1), day.replace(year=at.year + 1, month=1, day=1)),
                (2, day.replace(day=1), (day.replace(day=1) + 32 * DAY).replace(day=1)),
                (3, day, day + DAY),
                (4, at, at + HOUR),
            )
            level, at_next = next((level, after) for level, begin, after in units if at == begin and after <= self.end)
            yield at, level
            at = at_next

    def contains(self, ts: Column) -> Column:
        return (ts >= F.lit(self.start)) & (ts < F.lit(self.end))

    def prunes(self, keys: Sequence[str]) -> Column:
        """The same range as plain comparisons on year/month/day/hour partition keys."""
        return since_hour(keys, self.start) & _not_after(keys, _parts(self.end - HOUR))


def since_hour(keys: Sequence[str], moment: datetime) -> Column:
    """The hour of ``moment`` and later, as plain comparisons on partition keys."""
    return _not_before(keys, _parts(moment))


def _parts(moment: datetime) -> tuple[int, int, int, int]:
    return moment.year, moment.month, moment.day, moment.hour


def _not_before(keys: Sequence[str], bound: Sequence[int]) -> Column:
    key, value = F.col(keys[0]), bound[0]
    if len(keys) == 1:
        return key >= value
    return (key > value) | ((key == value) & _not_before(keys[1:], bound[1:]))


def _not_after(keys: Sequence[str], bound: Sequence[int]) -> Column:
    key, value = F.col(keys[0]), bound[0]
    if len(keys) == 1:
        return key <= value
    return (key < value) | ((key == value) & _not_after(keys[1:], bound[1:]))
