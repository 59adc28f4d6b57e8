"""Item-code parsing (F1, F2).

A code reads ``YY`` + season letters + 2-digit model + 2-char colour + size,
e.g. ``25W0303M40``. Digits are ASCII digits (the contract of this port).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from possum.functions.text import ustrip

# fixed values: code patterns
CODE_PATTERN = r"^(\d{2})([A-Za-z]+)(\d{2})([A-Za-z0-9]{2})(.+)$"
PREFIX_FULL = r"^(\d{2}[A-Za-z]+\d{2}[A-Za-z0-9]{2})"     # year+season+model+colour
PREFIX_NO_YEAR = r"^\d{2}([A-Za-z]+\d{2}[A-Za-z0-9]{2})"  # season+model+colour
PREFIX_NO_SEASON = r"^\d{2}[A-Za-z]+(\d{2}[A-Za-z0-9]{2})"  # model+colour


def clean_code(barcode: Column) -> Column:
    """``str(barcode or '').strip()``."""
    return ustrip(F.coalesce(barcode, F.lit("")))


def model_code(barcode: Column) -> Column:
    """Group 4 of the code, '' when the code does not parse."""
    return F.regexp_extract(clean_code(barcode), CODE_PATTERN, 4)


def size_code(barcode: Column) -> Column:
    """Group 5 of the code, '' when the code does not parse."""
    return F.regexp_extract(clean_code(barcode), CODE_PATTERN, 5)


def prefix_levels(barcode: Column) -> Column:
    """array<struct<lvl:int, pre:string>> of the three imputation prefixes.

    Empty when the code does not parse (all three patterns share one shape).
    """
    bc = clean_code(barcode)
    levels = F.array(*[
        F.struct(F.lit(i).alias("lvl"), F.regexp_extract(bc, pat, 1).alias("pre"))
        for i, pat in ((1, PREFIX_FULL), (2, PREFIX_NO_YEAR), (3, PREFIX_NO_SEASON))])
    # the three patterns match together or not at all
    empty = F.array().cast("array<struct<lvl:int,pre:string>>")
    return F.when(levels[0]["pre"] != "", levels).otherwise(empty)
