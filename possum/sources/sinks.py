"""S3 JSON / Parquet dataset sink, S4 sealed (AES-256-GCM) export."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, MapType, StructField,
                               StructType)

GCM_IV_BYTES = 12


def _no_decimals(t: DataType) -> DataType:
    if isinstance(t, DecimalType):
        return DoubleType()
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _no_decimals(f.dataType), f.nullable) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_no_decimals(t.elementType), t.containsNull)
    if isinstance(t, MapType):
        return MapType(_no_decimals(t.keyType), _no_decimals(t.valueType), t.valueContainsNull)
    return t


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal, nested ones included, to double (the JSON contract)."""
    return df.select(*[F.col(f.name).cast(_no_decimals(f.dataType)).alias(f.name)
                       for f in df.schema.fields])


def sink_order(spec: Sequence[str]) -> list[Column]:
    """Column order from names; a leading '-' sorts descending. Ascending
    puts nulls first and descending puts them last, as SQL Server does."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first()
            for c in spec]


def write_dataset(df: DataFrame, path: str, fmt: str = "json",
                  partition_by: Sequence[str] = (), mode: str = "overwrite",
                  order_by: Sequence[Column] = (), drop: Sequence[str] = (), dynamic: bool = False) -> None:
    """Write one dataset folder.

    JSON keeps nulls and renders timestamps as ``yyyy-MM-dd HH:mm``. With
    ``partition_by``, rows are first rebalanced on those columns (one file
    per folder unless a folder is too big for one task). A full run replaces
    the whole dataset, months that have vanished included; with ``dynamic``
    only the partitions present in ``df`` are replaced, for a run that
    recomputes some months and leaves the others in place. Use coarse
    partition columns (a month, not a day) for small aggregated datasets.

    ``order_by`` sorts at the sink only: a global sort (range partitions, so
    the part files in name order hold the rows in order), or, with
    ``partition_by``, a sort within each folder. ``drop`` removes helper
    columns (sort keys) after sorting.
    """
    df = decimals_to_double(df)
    if partition_by:
        # rows of one folder go to one task (one file per folder, not one per
        # task); AQE splits a folder too large for one task (REBALANCE)
        df = df.hint("rebalance", *partition_by)
        if order_by:
            df = df.sortWithinPartitions(*order_by)
    elif order_by:
        df = df.orderBy(*order_by)
    if drop:
        df = df.drop(*drop)
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "json":
        w.option("timestampFormat", "yyyy-MM-dd HH:mm").option("timestampNTZFormat", "yyyy-MM-dd HH:mm") \
         .option("ignoreNullFields", "false").option("encoding", "UTF-8").json(path)
    else:
        w.format(fmt).save(path)


FILE, BLOCK, LINE = "__file", "__block", "__line"


def with_places(df: DataFrame) -> DataFrame:
    """Rows just read from files, with the file name, the start of the split and a number that grows within a split."""
    return df.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                     F.monotonically_increasing_id().alias(LINE))


def _per_file(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*by, FILE, BLOCK).agg(*aggs)


def positions(df: DataFrame, by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """``with_places`` rows with their position (from 1) in the files in name order, per ``by``.

    Rows are numbered within their split of a file, which a task has read
    anyway; the splits' counts give the rows before each split. No window
    spans more rows than a split: only the splits' counts, one row for each,
    are added up in order.
    """
    counts = _per_file(df, by, F.count(F.lit(1)).alias("__rows"))
    ahead = Window.partitionBy(*by).orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate((*by, FILE, BLOCK))],
                           F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(*by, FILE, BLOCK).orderBy(LINE))
    numbered = df.withColumn("__place", place)
    same = [F.col(c).eqNullSafe(F.col(f"__{k}")) for k, c in enumerate((*by, FILE, BLOCK))]
    joined = numbered.join(before, same)
    return joined.select(*[c for c in df.columns if c not in (FILE, BLOCK, LINE)],
                         (F.col("__before") + F.col("__place")).cast("long").alias(name))


def disorder(df: DataFrame, order_by: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The places where ``with_places`` rows are out of order (``sink_order`` names), per ``by``: none when the files hold them in order.

    Neighbours are compared within a split, then the last row of each split
    with the first of the next one.
    """
    names = [c.lstrip("-") for c in order_by]

    def after(a, b):
        """Whether row a must come after row b."""
        out = F.lit(False)
        for c in reversed(order_by):
            n = c.lstrip("-")
            x, y = (b[n], a[n]) if c.startswith("-") else (a[n], b[n])  # descending: nulls last, as ascending read backwards
            more = F.when(x.isNull(), False).when(y.isNull(), True).otherwise(x > y)
            out = F.when(x.eqNullSafe(y), out).otherwise(more)
        return out

    row = F.struct(*names)
    inside = Window.partitionBy(*by, FILE, BLOCK).orderBy(LINE)
    pairs = df.select(*by, FILE, BLOCK, row.alias("b"), F.lag(row).over(inside).alias("a"))
    ends = _per_file(df, by, F.min_by(row, LINE).alias("b"), F.max_by(row, LINE).alias("last"))
    ends = ends.select(*by, FILE, BLOCK, "b", F.lag("last").over(Window.partitionBy(*by).orderBy(FILE, BLOCK)).alias("a"))
    wrong = pairs.unionByName(ends).filter(F.col("a").isNotNull() & after(F.col("a"), F.col("b")))
    return wrong.select(*by, F.col(FILE).alias("file"), F.col("a").alias("row"), F.col("b").alias("next_row"))


def row_key(key: Column, salt: Column) -> Column:
    """The key of the rows that carry ``salt``."""
    return F.unhex(F.sha2(F.concat(key, salt), 256))


def seal(df: DataFrame, key: Column, payload: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Per-row sealed payload.

    ``key`` is a 32-byte binary column, best ``key_frame.select("key").scalar()``
    (a scalar subquery: the key is not in the plan and no join is needed).
    Out: ``keep`` columns + v, salt, iv, ct; ``ct`` is ciphertext followed by
    the 16-byte tag, the layout browsers' Web Crypto expects. The IV is random
    per row, so equal payloads give different envelopes.

    Rows are not sealed under ``key`` itself but under the SHA-256 of key and
    salt. The salt is 16 bytes of this call and two random bytes of the row:
    random IVs stay far from the 2**32 rows one key may seal, each call has keys
    of its own, and the envelope says which.
    """
    call = F.lit(uuid.uuid4().bytes)
    # The IV is its own column, drawn from uuid() (non-deterministic, so the
    # optimizer never copies it into two expressions); the cipher call is
    # then used once.
    drawn = df.withColumn("_r", F.unhex(F.sha2(F.expr("uuid()"), 256)))
    with_iv = drawn.withColumn("_iv", F.substring("_r", 1, GCM_IV_BYTES)).withColumn(
        "_salt", F.concat(call, F.substring("_r", GCM_IV_BYTES + 1, 2)))
    blob = F.aes_encrypt(F.to_json(F.struct(*payload)), row_key(key, F.col("_salt")), F.lit("GCM"), F.lit("DEFAULT"),
                         F.col("_iv"))
    return with_iv.select(*keep, F.lit(1).alias("v"), F.base64("_salt").alias("salt"), F.base64("_iv").alias("iv"),
                          F.base64(F.substring(blob, GCM_IV_BYTES + 1, 1 << 30)).alias("ct"))


def unseal(sealed: DataFrame, key: Column, schema: StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Inverse of :func:`seal`: the payload columns back from salt, iv and ct."""
    blob = F.concat(F.unbase64("iv"), F.unbase64("ct"))
    text = F.aes_decrypt(blob, row_key(key, F.unbase64("salt")), F.lit("GCM")).cast("string")
    return sealed.select(*keep, F.from_json(text, schema).alias("_p")).select(*keep, "_p.*")


_PARTS = 4              # sums of a digest
_HEX = 15               # hexadecimal digits of a summand: below 2**60, so sums stay exact in DECIMAL(38,0)


def sealed_digest(sealed: DataFrame, key: Column) -> DataFrame:
    """One row (n, digest) that stands for the multiset of all sealed rows.

    An envelope proves its own row; nothing proves that all rows are there. Each
    row, kept columns included, gets a keyed hash of 240 bits, and the hashes are
    added up: the sum does not depend on the order of rows or files and is a
    partial aggregate, so no row is shuffled. Without the key nobody can make
    rows whose hashes make up for a dropped, doubled or changed one. The digest
    is a hash of the key, the number of rows and the sums.
    """
    names = sorted(sealed.columns)
    # lengths before values: no two rows read alike
    text = F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
                      for c in names])
    own = F.hex(key)
    row = sealed.select(F.sha2(F.concat(own, F.sha2(F.concat(own, F.lit("/"), text), 256)), 256).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + k * _HEX, _HEX), 16, 10).cast("decimal(38,0)")).alias(f"s{k}") for k in range(_PARTS)]
    total = row.agg(F.count(F.lit(1)).alias("n"), *sums)
    parts = [F.coalesce(F.col(f"s{k}"), F.lit(0)).cast("string") for k in range(_PARTS)]
    return total.select("n", F.sha2(F.concat_ws("|", own, F.lit("rows"), F.col("n").cast("string"), *parts), 256).alias("digest"))


def is_complete(sealed: DataFrame, key: Column, n: int, digest: str) -> bool:
    """Whether the rows are those that ``sealed_digest`` stands for, all of them and no other."""
    found = sealed_digest(sealed, key).first()
    return found.n == n and found.digest == digest
