"""Row rules shared by the queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from possum.rules import Rules


def master_live(status: Column) -> Column:
    return status == 1


def fact_live(status: Column) -> Column:
    return status > -1


def doc_live(status: Column) -> Column:
    return status > 0


def discount_live(status: Column) -> Column:
    return F.coalesce(status, F.lit(0)) > -1


def catalogue_item(dept_name: Column, item_name: Column, barcode: Column, rules: Rules) -> Column:
    """Not the general department, name without the token, barcode not denied.

    A null name or barcode fails the test, as in SQL.
    """
    return ((F.coalesce(dept_name, F.lit("")) != F.lit(rules.general_department))
            & ~item_name.contains(rules.general_name_token)
            & ~barcode.isin(*rules.barcode_deny))
