"""Read a branch's POS database over JDBC into a bundle.

Big fact tables are read in parallel: ``partitionColumn`` with bounds and
``numPartitions`` split the scan into range queries, one per task, and
filters written on the DataFrame are pushed into each range query. Small
dimensions are read in one query.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle
from possum.sources.optional import empty
from possum.sources.splits import equal_predicates

# fixed values: canonical table -> (source table, range-split column or None);
# the names are the POS database's own (the two ledger tables are extracts of
# an accounting system kept in the same database)
SOURCE_TABLES: dict[str, tuple[str, str | None]] = {
    "store": ("Store", None),
    "department": ("Department", None),
    "item_main": ("ItemMain", "ItemID"),
    "item_group": ("ItemGroup", None),
    "item_to_group": ("ItemToGroup", "ItemID"),
    "item_store": ("ItemStore", "ItemStoreID"),
    "pos_transaction": ("[Transaction]", "TransactionID"),
    "transaction_entry": ("TransactionEntry", "TransactionEntryID"),
    "tender": ("Tender", None),
    "tender_entry": ("TenderEntry", "TransactionID"),
    "users": ("Users", "UserId"),
    "user_store": ("UserStore", "UserID"),
    "suppliers_docs": ("SuppliersDocs", "ID"),
    "suppliers_docs_entry": ("SuppliersDocsEntry", "ID"),
    "supplier_dim": ("Supplier", None),
    "promotion": ("Promotion", None),
    "transaction_discounts": ("TransactionDiscounts", "TDiscountID"),
    "tentry_discount": ("TEntryDiscount", "TransactionEntryID"),
    "presence_view": ("PresenceView", "UserID"),
    "ledger_monthly": ("RivhitMonthly", None),
    "ledger_invoices": ("RivhitInvoices", "HenNum"),
}


@dataclass(frozen=True)
class JdbcBranch:
    """One branch database. Credentials come from the caller (a secret
    store), never from this repository."""
    name: str
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    label: str | None = None
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
    fetchsize: int = 10_000
    query_timeout_s: int = 0
    # range splits of equal row counts instead of equal width (sources.splits)
    equal_splits: bool = False
    # canonical table -> source table, where a database names them otherwise
    table_names: Mapping[str, str] = field(default_factory=dict, repr=False)

    def source_table(self, canonical: str) -> str:
        return self.table_names.get(canonical, SOURCE_TABLES[canonical][0])


def jdbc_options(src: JdbcBranch, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None) -> dict[str, str]:
    opts = {"url": src.url, "dbtable": table, "driver": src.driver,
            "fetchsize": str(src.fetchsize), "queryTimeout": str(src.query_timeout_s),
            # source times have no zone: read as they are, no shift by the JVM's zone
            "preferTimestampNTZ": "true"}
    if src.user is not None:
        opts["user"] = src.user
    if src.password is not None:
        opts["password"] = src.password
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a range-split read needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    return opts


def _bounds(spark: SparkSession, src: JdbcBranch, table: str, col: str) -> tuple[int, int] | None:
    """MIN/MAX of the split column: one row, computed by the database."""
    opts = jdbc_options(src, table)
    opts.pop("dbtable")
    opts["query"] = f'SELECT MIN("{col}") AS "lo", MAX("{col}") AS "hi" FROM {table}'
    row = spark.read.format("jdbc").options(**opts).load().first()
    if row is None or row[0] is None:
        return None
    return int(row[0]), int(row[1])


MOST_COUNTS = 1 << 24   # splits.BUCKETS * splits.FINE for each of 16,384 partitions


def _query(spark: SparkSession, src: JdbcBranch, sql: str) -> list[tuple]:
    """The rows of a query that the database answers, bucket counts only."""
    opts = jdbc_options(src, "")
    opts.pop("dbtable")
    rows = spark.read.format("jdbc").options(**opts, query=sql).load().take(MOST_COUNTS + 1)
    if len(rows) > MOST_COUNTS:
        raise ValueError(f"more than {MOST_COUNTS} bucket counts; ask for fewer partitions")
    return [tuple(r) for r in rows]


def read_table(spark: SparkSession, src: JdbcBranch, canonical: str,
               num_partitions: int = 64) -> DataFrame:
    table, split = src.source_table(canonical), SOURCE_TABLES[canonical][1]
    reader = spark.read.format("jdbc")
    if split and src.equal_splits:
        opts = jdbc_options(src, table)
        df = spark.read.jdbc(opts.pop("url"), opts.pop("dbtable"), properties=opts, predicates=equal_predicates(
            lambda sql: _query(spark, src, sql), table, f'"{split}"', num_partitions))
    else:
        bounds = _bounds(spark, src, table, split) if split else None
        if bounds is not None:
            opts = jdbc_options(src, table, split, bounds[0], bounds[1] + 1, num_partitions)
        else:
            opts = jdbc_options(src, table)
        df = reader.options(**opts).load()
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    # no cast where the types agree: a bound on a bare column reaches the database
    return df.select(*[F.col(f.name).alias(f.name) if kinds.get(f.name.lower()) == f.dataType
                       else F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(canonical).fields])


def read_optional(spark: SparkSession, src: JdbcBranch, canonical: str, num_partitions: int) -> DataFrame:
    """The table, or an empty frame with a warning when it is missing or can't be opened."""
    try:
        return read_table(spark, src, canonical, num_partitions)
    except (PySparkException, Py4JJavaError) as e:
        warnings.warn(f"{src.name}: optional table {canonical} is taken as empty: {str(e).splitlines()[0]}", stacklevel=2)
        return empty(spark, canonical)


def read_branch(spark: SparkSession, src: JdbcBranch, num_partitions: int = 64,
                missing: tuple[str, ...] = ()) -> Bundle:
    """All canonical tables of one branch, tagged with its name.

    Optional tables that are missing or can't be opened are empty frames of the
    declared schema (S2); ``missing`` names some that aren't even tried.
    """
    tables: dict[str, DataFrame] = {}
    for canonical in SOURCE_TABLES:
        if canonical in missing:
            if canonical not in schemas.OPTIONAL:
                raise ValueError(f"{canonical} is required")
            df = empty(spark, canonical)
        else:
            read = read_optional if canonical in schemas.OPTIONAL else read_table
            df = read(spark, src, canonical, num_partitions)
        tables[canonical] = df.withColumn("branch", F.lit(src.name))
    tables["store"] = tables["store"].withColumn("StoreNameOrig", F.col("StoreName"))
    return Bundle(tables, (Branch(src.name),))
