"""Range splits of equal row counts for a table read by an id.

Equal-width ranges between MIN and MAX read almost nothing in most tasks and
almost everything in one when ids are skewed (a gap after a migration, blocks
of ids per store). Here the database counts its ids in buckets; buckets that
hold more than a small share of the rows are counted again in finer ones, all
of a round in one query, until they are light or hold one id. The split points
cut the counts into equal parts. Only bucket counts come to the driver: a round
has at most ``BUCKETS`` rows for each of at most ``FINE * parts`` heavy buckets.

The queries are plain SQL over integers and run as they are on the branch
databases, Spark SQL and DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

BUCKETS = 256
FINE = 4

Run = Callable[[str], Iterable[tuple]]


def key_histogram(run: Run, table: str, column: str, parts: int) -> list[tuple[int, int, int]]:
    """(first id, last id, rows) of buckets that are light or hold one id, by id; no rows give none.

    ``run`` sends a query to the database and gives its rows. Null ids are not counted.
    """
    lo, hi, total = next(iter(run(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n FROM {table}")))
    if not total:
        return []
    lo, hi, total = int(lo), int(hi), int(total)
    heavy, done, width = [(lo, hi)], [], 1
    while width * BUCKETS <= hi - lo:
        width *= BUCKETS
    while heavy:
        where = " OR ".join(f"{column} BETWEEN {a} AND {b}" for a, b in heavy)
        offset = f"({column} - ({lo}))"
        got = {int(start): int(n) for start, n in run(
            f"SELECT {offset} - {offset} % {width} AS start, COUNT(*) AS n FROM {table} WHERE {where} "
            f"GROUP BY {offset} - {offset} % {width}")}
        heavy = []
        for start, n in got.items():
            bucket = (lo + start, lo + start + width - 1)
            if width > 1 and n * FINE * parts > total:
                heavy.append(bucket)
            else:
                done.append((*bucket, n))
        width //= BUCKETS  # finer buckets lie whole in the ones before
    return sorted(done)


def split_points(histogram: list[tuple[int, int, int]], parts: int) -> list[int]:
    """At most parts - 1 ids, each the first of a split, so that splits have nearly equal rows.

    A split is a whole number of buckets; one id with more rows than a split has one of its own.
    """
    total = sum(n for _, _, n in histogram)
    points, before = [], 0
    for at, _, n in histogram:
        # cut where a part's end lies nearer to the bucket's start than to its end
        want = (before + n / 2) * parts // total if total else 0
        if before and want > len(points):
            points.append(at)
            points += [at] * int(want - len(points))  # a bucket over several parts takes their place
        before += n
    return sorted(set(points))


def range_predicates(column: str, points: list[int]) -> list[str]:
    """SQL conditions, one for each split; every row, a null id included, meets exactly one."""
    if not points:
        return ["1 = 1"]
    first = [f"{column} < {points[0]} OR {column} IS NULL"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:], strict=False)]
    return [*first, *middle, f"{column} >= {points[-1]}"]


def equal_predicates(run: Run, table: str, column: str, parts: int) -> list[str]:
    """Conditions that split the table into at most ``parts`` ranges of nearly equal rows."""
    return range_predicates(column, split_points(key_histogram(run, table, column, parts), parts))
