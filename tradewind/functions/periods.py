"""Month spellings and the publication calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# spelling -> (start of year, start of month), one-based
_PLACES = {
    "MM/YYYY": (4, 1),
    "0YYYYMM": (2, 6),
    "YYYYMM": (1, 5),
    "YYYY-MM": (1, 6),
}


def to_month(period: Column, style: str) -> Column:
    """Canonical ``yyyy-MM`` from one of the raw spellings."""
    year, month = _PLACES[style]
    return F.concat(F.substring(period, year, 4), F.lit("-"), F.substring(period, month, 2))


def from_month(month: Column, style: str) -> Column:
    """Raw spelling of a canonical ``yyyy-MM`` month."""
    year, mm = F.substring(month, 1, 4), F.substring(month, 6, 2)
    return {
        "MM/YYYY": F.concat(mm, F.lit("/"), year),
        "0YYYYMM": F.concat(F.lit("0"), year, mm),
        "YYYYMM": F.concat(year, mm),
        "YYYY-MM": F.concat(year, F.lit("-"), mm),
    }[style]


def spell_month(month: str, style: str) -> str:
    year, mm = month[:4], month[5:7]
    return {"MM/YYYY": f"{mm}/{year}", "0YYYYMM": f"0{year}{mm}",
            "YYYYMM": f"{year}{mm}", "YYYY-MM": f"{year}-{mm}"}[style]


def month_list(start: str, end: str) -> list[str]:
    """Every ``yyyy-MM`` from start to end."""
    first = int(start[:4]) * 12 + int(start[5:7]) - 1
    last = int(end[:4]) * 12 + int(end[5:7]) - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def next_month(month: str) -> str:
    n = int(month[:4]) * 12 + int(month[5:7])
    return f"{n // 12:04d}-{n % 12 + 1:02d}"


def month_start(month: Column) -> Column:
    return F.to_date(F.concat(month, F.lit("-01")))


def in_month_range(period: Column, start: str | None, end: str | None, style: str) -> Column:
    """Period is one of the months from start to end, in the given spelling; None is no bound on that side."""
    if start is None or end is None:
        month = to_month(period, style)
        bounds = [month >= start] if start is not None else [month <= end] if end is not None else [F.lit(True)]
        return bounds[0]
    return period.isin([spell_month(m, style) for m in month_list(start, end)])


def publication_lag(as_of: Column, cutoff_day: int = 15, rule: str = "after") -> Column:
    """Months between a day and the latest published month: 2, or 3 early in the month.

    ``rule="after"`` needs the day to be past the cut-off for 2; ``rule="from"`` accepts the day itself.
    """
    day = F.dayofmonth(as_of)
    late = day > cutoff_day if rule == "after" else day >= cutoff_day
    return F.when(late, F.lit(2)).otherwise(F.lit(3))


def latest_month(as_of: Column, cutoff_day: int = 15, rule: str = "from") -> Column:
    """Latest published month, ``yyyy-MM``, on a given day."""
    month = F.add_months(F.trunc(as_of, "MM"), -publication_lag(as_of, cutoff_day, rule))
    return F.date_format(month, "yyyy-MM")
