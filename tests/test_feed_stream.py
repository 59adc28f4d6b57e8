"""D24 as files arrive: any order and any batching gives the batch result."""

from __future__ import annotations

import json
import os
import random

import pytest

from possum.operators.assemble import net_feed_days
from possum.sources.feed import read_feed
from possum.streaming.feed import read_days, start_feed

COLUMNS = ("day", "net", "raw", "session_ok")


def _rows(df):
    return sorted(map(repr, df.select(*COLUMNS).collect()))


def _files(seed):
    """Name, fetch time and text of files whose days overlap, odd entries included."""
    rng = random.Random(seed)
    out = []
    for k in range(9):
        days = {f"{rng.randint(1, 9)}/{rng.randint(1, 2)}/2024": rng.choice([rng.randint(1, 99), {"net": rng.randint(1, 99)}, None, "x"])
                for _ in range(5)}
        text = json.dumps({"days": days, "sessionOk": rng.choice([True, False])})
        # fetch times repeat and reach back for years, far beyond the newest file's
        out.append((f"f{k}.json", 1_700_000_000 - rng.randint(0, 3) * 40_000_000, text))
    out.append(("g.json", 1_700_000_000, "{}"))
    out.append(("h.json", 1_700_000_000, "not json"))
    out.append(("i.json", 1_700_000_000, ""))
    return out


@pytest.mark.parametrize(("seed", "runs", "at_once"), [(1, 3, 1), (2, 2, 4), (3, 1, None)])
def test_any_order_and_batching_equals_the_batch(spark, tmp_path, seed, runs, at_once):
    files, days, state = (str(tmp_path / x) for x in ("files", "days", "state"))
    os.mkdir(files)
    todo = _files(seed)
    random.Random(seed + 100).shuffle(todo)
    for r in range(runs):
        for name, at, text in todo[r::runs]:
            path = os.path.join(files, name)
            with open(path + ".tmp_", "w", encoding="utf-8") as f:
                f.write(text)
            os.utime(path + ".tmp_", (at, at))
            os.rename(path + ".tmp_", path)
        q = start_feed(spark, files, days, state, at_once)
        q.awaitTermination(200)
        assert q.exception() is None
        assert _rows(read_days(spark, days)) == _rows(net_feed_days(read_feed(spark, files)))
    assert len([x for x in os.listdir(days) if x.startswith("feed-")]) <= 2  # older versions are gone


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    files, days, state = (str(tmp_path / x) for x in ("files", "days", "state"))
    os.mkdir(files)
    with open(os.path.join(files, "a.json"), "w", encoding="utf-8") as f:
        f.write('{"days": {"1/2/2024": 5, "3/2/2024": {"net": 7.25}}}')
    for _ in range(2):
        q = start_feed(spark, files, days, state)
        q.awaitTermination(200)
        assert [(r.day, float(r.net)) for r in read_days(spark, days).orderBy("day").collect()] == [("2024-02-01", 5.0), ("2024-02-03", 7.25)]
