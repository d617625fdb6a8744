"""Scalar functions: Column in, Column out, no Python in the row path."""

from .calendar import calendar_parts, utc_date
from .money import parse_int, parse_money, to_usd
from .text import clean_sku, row_json, sku_key
from .times import dmy_to_utc, iso_to_utc, naive_to_utc, utc_to_wall, wall_to_utc

__all__ = [
    "calendar_parts",
    "clean_sku",
    "dmy_to_utc",
    "iso_to_utc",
    "naive_to_utc",
    "parse_int",
    "parse_money",
    "row_json",
    "sku_key",
    "to_usd",
    "utc_date",
    "utc_to_wall",
    "wall_to_utc",
]
