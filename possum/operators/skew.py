"""Joins of facts where one key may hold a large part of the rows.

AQE splits a skewed partition only behind a shuffle; facts stored in buckets of
their join key are read without one, so a hot key's bucket is one task. Here the
heavy keys are found by a sketch of the key columns, and only their rows are
salted: the fact's rows of a heavy key are dealt over as many salts as its share
asks for, the other side's rows of the key are repeated once for each salt, and
all other rows join as before, from their buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000        # items of the sketch: keys above about 1 / 7,500 of the rows are found
MOST = 1_000            # heavy keys at most, as each has more than SHARE of the rows
SHARE = 1 / MOST
CHUNKS = 16             # salts for each shuffle partition, so that chance evens out
_SEP = "\x1f"


class HeavyKeys(NamedTuple):
    keys: tuple[str, ...]
    salts: dict[str, int]       # key as text -> number of salts


def _text(keys: Sequence[str]) -> Column:
    return F.concat_ws(_SEP, *[F.col(k).cast("string") for k in keys])


def heavy_keys(facts: DataFrame, keys: Sequence[str], share: float = SHARE) -> HeavyKeys:
    """The keys with more than ``share`` of the rows, by a frequent-items sketch.

    One pass over the key columns; sketches are merged, and at most 1 / share
    keys come to the driver. Rows with a null key join nothing and don't count.
    """
    named = facts.where(" and ".join(f"`{k}` is not null" for k in keys)).select(_text(keys).alias("k"))
    most = min(math.ceil(1 / share), MOST)
    row = named.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(TRACKED, most)})").alias("top")).first()
    parts = CHUNKS * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = {t["item"]: math.ceil(parts * t["count"] / row.n) for t in (row.top or []) if t["count"] > share * row.n}
    return HeavyKeys(tuple(keys), {k: v for k, v in salts.items() if v > 1})


def salted_join(facts: DataFrame, other: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """``facts.join(other, heavy.keys)`` (inner) with the rows of heavy keys salted."""
    keys = list(heavy.keys)
    if not heavy.salts:
        return facts.join(other, keys)
    text = _text(keys)
    hot = text.isin(*heavy.salts)
    salts = F.element_at(F.create_map(*[F.lit(x) for pair in heavy.salts.items() for x in pair]), text)
    # the same number for the same stored row, also when a task runs again
    dealt = facts.where(hot).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), salts.cast("long")).cast("int"))
    copies = other.where(hot).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    cold = facts.where(~hot | hot.isNull()).join(other, keys)
    return cold.unionByName(dealt.join(copies, [*keys, "__salt"]).drop("__salt"))
