"""Calendar expressions: day-first parsing, cyclic encodings, fold numbers."""

import datetime as dt

from pyspark.sql import Column, functions as F

from brimline.settings import DATE_FORMATS


def parse_day_first(text):
    """Date from day-first text; ISO text is read as ISO, anything else gives NULL."""
    return F.coalesce(*[F.try_to_date(F.trim(text), f) for f in DATE_FORMATS])


def cyclic(position: Column, period: int, trig) -> Column:
    return trig(position * F.lit(2.0) * F.pi() / F.lit(float(period)))


def seasonal(date="date") -> dict[str, Column]:
    """Month and day-of-year on the unit circle (day 366 wraps past one turn)."""
    month, doy = F.month(date), F.dayofyear(date)
    return {
        "month_sin": cyclic(month, 12, F.sin),
        "month_cos": cyclic(month, 12, F.cos),
        "doy_sin": cyclic(doy, 365, F.sin),
        "doy_cos": cyclic(doy, 365, F.cos),
    }


def fold_start(fold, start: str, months: int) -> Column:
    """First date of fold number `fold`."""
    return F.add_months(F.lit(_checked(start)), (fold * F.lit(months)).cast("int"))


def fold_of(date, start: str, months: int) -> Column:
    """Number of the fold a date falls in; -1 for every date before the first fold.

    Fold edges are a fixed calendar grid, so the fold of a row is arithmetic on its own date and
    needs no range join against a table of folds.
    """
    first = _checked(start)
    elapsed = ((F.year(date) - first.year) * 12 + F.month(date) - first.month
               - (F.dayofmonth(date) < first.day).cast("int"))
    return F.greatest(F.floor(elapsed / F.lit(months)), F.lit(-1)).cast("int")


def _checked(start: str) -> dt.date:
    first = dt.date.fromisoformat(start)
    if first.day > 28:
        raise ValueError(f"the first fold must start on a day every month has, got {start}")
    return first
