"""Date expressions and the label / feature window arithmetic."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunetrail.functions.exprs import strip_blanks


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def parse_yyyymmdd(c: Column | str) -> Column:
    """Strip, read year / month / day from the first 8 characters, null when invalid.

    Each part is read on its own (a short or padded part still counts, as an
    integer parse of the slice would), so '2017 4 5' and '20170405xyz' both
    give 2017-04-05 while '20171330' gives null.
    """
    s = strip_blanks(c)
    year = F.substring(s, 1, 4).try_cast("int")
    month = F.substring(s, 5, 2).try_cast("int")
    day = F.substring(s, 7, 2).try_cast("int")
    # try_to_date rejects month 13, day 31 of a 30-day month, Feb 30, year 0
    # and negative parts (formatted with a sign) instead of rolling over.
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def in_range(c: Column | str, start, end) -> Column:
    """inclusive date range."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.lit(_as_date(start)), F.lit(_as_date(end)))


def trailing(c: Column | str, snapshot, days: int) -> Column:
    """the ``days`` days ending at ``snapshot`` inclusive: [s-(days-1), s]."""
    s = _as_date(snapshot)
    return in_range(c, s - dt.timedelta(days - 1), s)


@dataclass(frozen=True)
class Windows:
    """M1: label window of ``label_days`` ending ``label_end``; feature window of
    ``feature_days`` ending the day before the label window starts."""

    label_end: dt.date
    label_days: int = 14
    feature_days: int = 30
    sub_windows: tuple = field(default=(1, 3, 7, 14, 30))

    @staticmethod
    def of(label_end, label_days: int = 14, feature_days: int = 30, sub_windows=(1, 3, 7, 14, 30)):
        return Windows(_as_date(label_end), label_days, feature_days, tuple(sub_windows))

    @property
    def label_start(self) -> dt.date:
        return self.label_end - dt.timedelta(self.label_days - 1)

    @property
    def feature_end(self) -> dt.date:
        return self.label_start - dt.timedelta(1)

    @property
    def feature_start(self) -> dt.date:
        return self.feature_end - dt.timedelta(self.feature_days - 1)

    @property
    def snapshot(self) -> dt.date:
        """Features are computed as of the last day of the feature window."""
        return self.feature_end


# The reference's windows over its 2017 logs (label 14 days ending
# 2017-05-12, features 30 days before it, sub-windows 1/3/7/14/30).
REFERENCE_WINDOWS = Windows.of("2017-05-12", 14, 30, (1, 3, 7, 14, 30))

# Windows used on the driver's ``events`` table (30 days of January 2024):
# label 3 days 01-28..01-30, features 14 days 01-14..01-27, sub-windows 1/3/7/14.
DRIVER_WINDOWS = Windows.of("2024-01-30", 3, 14, (1, 3, 7, 14))
