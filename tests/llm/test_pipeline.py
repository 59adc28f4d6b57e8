from __future__ import annotations

import os
import subprocess
import sys

import corpus_pipeline
from possum.llm import neardup
from possum.llm.staging import staged
from tests.llm.brute import base_secrets, components, contaminated

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BIG = "/root/testdata/sf0.01"


def test_stages_take_effect_and_leave_the_rest(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{BIG}/benchmark.parquet").collect()]
    before, steps = {r.doc_id: r for r in docs.collect()}, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, BIG), "test")
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if k < 4:
            assert docs.columns == COLUMNS
        steps.append((before, after))
        before = after
    a, b = steps[0]  # quality: bad documents go, good ones stay
    bad = [i for i, q in labels.items() if q == 0 and i in a]
    good = [i for i, q in labels.items() if q == 1 and i in a]
    assert sum(i in b for i in bad) <= 0.05 * len(bad) and sum(i in b for i in good) >= 0.98 * len(good)
    a, b = steps[1]  # one of each group
    assert set(b) == {c for _, _, c in components([(i, r.text) for i, r in a.items()])} if len(a) < 400 else \
        set(b) == {r.doc_id for r in neardup.near_duplicates(spark.createDataFrame(list(a.values()))).collect() if r.kept}
    a, b = steps[2]
    ids = list(a)
    assert set(b) == {i for i, w in zip(ids, contaminated([a[i].text for i in ids], items), strict=True) if not w[4]}
    a, b = steps[3]  # every document stays; only those with secrets change, and hold none afterwards
    assert set(a) == set(b)
    for i in a:
        assert (b[i].text != a[i].text) == bool(base_secrets(a[i].text)) and not base_secrets(b[i].text)
        assert b[i].n_chars == (len(b[i].text) if b[i].text != a[i].text else a[i].n_chars)
    a, b = steps[4]
    assert all(r.copies >= 1 and r.text == a[i].text for i, r in b.items())


def test_run_on_the_smallest_tables(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*COLUMNS, "copies", "taken"] and out.count() > 0


def test_entry_point_stands_without_this_package(tmp_path):
    """__spark_entry__ imports from a tree that has neither the package nor the pipeline."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "possum", "possum_checks"):
        os.symlink(os.path.join(root, name), tmp_path / name) if name != "possum" else (tmp_path / name).mkdir()
    for name in os.listdir(os.path.join(root, "possum")):
        if name != "llm":
            os.symlink(os.path.join(root, "possum", name), tmp_path / "possum" / name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(os.path.join(root, "__spark_entry__.py")).read())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1') or n == 'pipeline' for n in q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert said.stdout.split()[1:] == ["False"] and int(said.stdout.split()[0]) >= 33, said.stderr
