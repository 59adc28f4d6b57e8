"""D9c user directory, M4 first-branch-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.text import ustrip
from possum.rules import Rules


def _python_int(code: Column) -> Column:
    """``int(text)`` for decimal digit strings (sign, '_' separators, outer
    whitespace allowed); null when Python would raise. ASCII digits only,
    the same contract as item codes (Python also reads other Unicode digits)."""
    s = ustrip(code)
    ok = s.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$")
    return F.when(ok, F.regexp_replace(s, "_", "").try_cast("int"))


def user_directory(bundle: Bundle, rules: Rules) -> DataFrame:
    """branch, no, display, user, hash, role, store (order by UserNo at the sink).

    ``store`` is the label of the user's first store code (text order; a
    null code sorts first and yields ''). The password is never read:
    ``hash`` is a salted SHA-256 of the user number, a pseudonymous key.
    """
    us = bundle["user_store"].join(bundle["store"].select("branch", "StoreID", "Code"),
                                   ["branch", "StoreID"])
    first_code = us.groupBy("branch", "UserID").agg(
        F.when(F.count(F.lit(1)) > F.count("Code"), F.lit(None)).otherwise(F.min("Code")).alias("StoreCode"))
    u = bundle["users"].where(F.col("IsUser") == 1).withColumnRenamed("UserId", "UserID")
    j = bundle.with_branch_order(u.join(first_code, ["branch", "UserID"], "left"))
    full = F.trim(F.concat(F.coalesce(F.col("UserFName"), F.lit("")), F.lit(" "),
                           F.coalesce(F.col("UserLName"), F.lit(""))))
    display = F.when(ustrip(full) != "", ustrip(full)).otherwise(
        F.coalesce(F.nullif(F.col("UserName"), F.lit("")), F.nullif(F.col("UserNo"), F.lit("")), F.lit("")))
    labels = F.create_map(*[x for k, v in rules.user_store_labels for x in (F.lit(k), F.lit(v))])
    code = F.coalesce(_python_int(F.col("StoreCode")), F.lit(0))
    store = F.coalesce(F.col("branch_label"), F.coalesce(F.element_at(labels, code), F.lit("")))
    return j.select(
        "branch", ustrip(F.coalesce(F.col("UserNo"), F.lit(""))).alias("no"), display.alias("display"),
        ustrip(F.coalesce(F.col("UserName"), F.lit(""))).alias("user"),
        F.sha2(F.concat_ws("|", F.coalesce(F.col("UserNo"), F.lit("")), F.lit(rules.user_key_salt)),
               256).alias("hash"),
        F.when(F.coalesce(F.col("IsSuperAdmin"), F.lit(0)) != 0, F.lit(rules.role_admin))
         .otherwise(F.lit(rules.role_employee)).alias("role"),
        store.alias("store"))


def dedupe_first(df: DataFrame, bundle: Bundle, keys: Sequence[str],
                 order: Sequence[str] = ()) -> DataFrame:
    """M4: one row per key, the first branch's (then lowest ``order``) row.

    An aggregate (min_by over (branch_rank, order...)), not a window: each
    task reduces its rows per key before the shuffle, so a key repeated a
    billion times never gathers in one task.
    """
    ranked = bundle.with_branch_order(df)
    rest = [c for c in df.columns if c not in keys]
    picked = ranked.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct("branch_rank", "branch", *order)).alias("r"))
    return picked.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)
