"""D24 input: the external net-amount feed, kept as JSON files.

Each file holds ``{"days": {"d/m/yyyy": <amount or object>, ...}, "sessionOk": true, ...}``.
The ``days`` object has unknown keys, so it is parsed as a map (R5) and
exploded into rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.sources.optional import optional_table

_FILE = ("value", "_metadata.file_modification_time AS fetched", "_metadata.file_path AS file")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(day_key, net, raw, session_ok, fetched, file): one row per day entry of every feed file.

    ``raw`` is the entry's JSON text; ``net`` its number when the entry is a
    bare number, else its ``net`` field. ``session_ok`` is the file's
    ``sessionOk`` (true when it has none); ``fetched`` is the file's
    modification time. No file gives an empty frame.
    """
    text = optional_table(spark, "net_feed", lambda: spark.read.text(path, wholetext=True).selectExpr(*_FILE))
    if "value" not in text.columns:
        return spark.createDataFrame([], "day_key string, net decimal(18,2), raw string, session_ok boolean, "
                                         "fetched timestamp, file string")
    return entries(text)


def stream_feed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same rows as files arrive; a file counts however old it is when it comes."""
    reader = spark.readStream.option("wholetext", True).option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return entries(reader.text(path).selectExpr(*_FILE))


def entries(text: DataFrame) -> DataFrame:
    """The day entries of whole files (value, fetched, file)."""
    ok = F.coalesce(F.get_json_object("value", "$.sessionOk").try_cast("boolean"), F.lit(True))
    days = text.select(F.explode(F.from_json(
        F.get_json_object("value", "$.days"), "map<string,string>")).alias("day_key", "raw"),
        ok.alias("session_ok"), "fetched", "file")
    net = F.coalesce(F.col("raw").try_cast("decimal(18,2)"),
                     F.get_json_object("raw", "$.net").try_cast("decimal(18,2)"))
    return days.select("day_key", net.alias("net"), "raw", "session_ok", "fetched", "file")
