from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar names shown in the reports.
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), position)


def utc_date(instant: Column) -> Column:
    """Calendar date of an instant (the session runs in UTC)."""
    return F.to_date(instant)


def calendar_parts(day: Column) -> list[Column]:
    """The calendar attributes of a date; ISO weekday (Monday is 1) and ISO week."""
    weekday = F.weekday(day) + 1
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        _pick(MONTH_NAMES, F.month(day)).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        _pick(DAY_NAMES, weekday).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (weekday >= 6).alias("is_weekend"),
    ]
