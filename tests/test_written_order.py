"""O1 read back: positions and order of rows over many files and splits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from possum.sources.sinks import disorder, positions, sink_order, with_places

SCHEMA = "branch string, a int, b string, n long"
ORDER = ["a", "-b"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'x' WHEN id % 97 = 1 THEN NULL ELSE 'y' END AS branch",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id * 7919 % 500 AS INT) END AS a",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 13 AS STRING) END AS b", "id AS n")


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _back(spark, path):
    return with_places(spark.read.schema(SCHEMA).json(path))


def test_positions_are_those_of_the_sort(spark, rows, tmp_path, small_splits):
    path = str(tmp_path / "sorted")
    rows.repartitionByRange(5, *sink_order(ORDER), "n").sortWithinPartitions(*sink_order(ORDER), "n").write.json(path)
    back = _back(spark, path)
    assert back.select("__file", "__block").distinct().count() > 10
    got = positions(back, ["branch"]).collect()
    want = {}
    for r in rows.orderBy(*sink_order(ORDER), "n").collect():
        want.setdefault(r.branch, []).append(r.n)
    assert {(r.branch, r.position, r.n) for r in got} == {(k, p + 1, n) for k, v in want.items() for p, n in enumerate(v)}
    assert sorted(r.position for r in positions(back).collect()) == list(range(1, 6001))
    assert disorder(back, ORDER).count() == 0 and disorder(back, ORDER, ["branch"]).count() == 0


def test_disorder_is_found_inside_and_between_files(spark, rows, tmp_path, small_splits):
    path = str(tmp_path / "sorted")
    parts = rows.repartitionByRange(5, *sink_order(ORDER), "n").sortWithinPartitions(*sink_order(ORDER), "n")
    parts.write.json(path)
    first = min(r.f for r in _back(spark, path).select(F.col("__file").alias("f")).distinct().collect())
    name = tmp_path / "sorted" / first
    lines = name.read_text().splitlines()
    name.write_text("\n".join([*lines[:50], lines[900], *lines[51:900], lines[50], *lines[901:]]) + "\n")
    (tmp_path / "sorted" / f".{first}.crc").unlink(missing_ok=True)
    got = disorder(_back(spark, path), ORDER).collect()
    assert 1 <= len(got) <= 4 and {r.file for r in got} == {first}
    # files in the wrong order: every boundary but none inside
    path = str(tmp_path / "backwards")
    for k in range(3):
        rows.filter((F.col("a") >= 200 - 100 * k) & (F.col("a") < 300 - 100 * k)).coalesce(1).sortWithinPartitions(*sink_order(ORDER)) \
            .write.json(f"{path}/part={k}")
    back = _back(spark, f"{path}/*")
    back = back.withColumn("__file", F.concat(F.regexp_extract(F.input_file_name(), "part=[0-9]", 0), "__file"))
    assert disorder(back, ORDER).count() == 2


def test_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.json(path)
    assert positions(_back(spark, path), ["branch"]).count() == 0 and disorder(_back(spark, path), ORDER).count() == 0
