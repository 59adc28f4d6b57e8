"""Quality and toxicity: held-out accuracy on the synthetic labels, and odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from possum.llm import labelled, quality, toxicity
from possum.llm.queries import QUERIES

BIG = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    ones = int(y.sum())
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize(("name", "label", "least_auc", "least_right"), [
    ("op5_quality_classifier", "quality", 0.99, 0.98), ("op7_toxicity_cnn", "toxic", 0.95, 0.96)])
def test_held_out_accuracy(spark, name, label, least_auc, least_right):
    got = QUERIES[name](spark, BIG)
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", label).toPandas()
    assert len(rows) > 500
    assert auc(rows.score.to_numpy(), rows[label].to_numpy()) >= least_auc
    assert (rows.predicted == rows[label]).mean() >= least_right
    if label == "quality":  # good documents are kept
        assert rows.predicted[rows.quality == 1].mean() >= 0.99


def small(spark, docs):
    good, bad = "the cat sat on the mat and the dog ran", "STUPID!! IDIOT!! ***"
    rows = [(i, bad if i % 2 else good) for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "..."), (1003, "word " * 20_000), (1, bad), (1, bad), (None, good)]
    labels = [(i, 1 - i % 2, i % 2) for i in range(60)] + [(None, 1, 0), (3, None, None), (5, 0, 1), (99_999, 1, 0)]
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_odd_rows(spark, docs, score):
    table, labels, rows = small(spark, docs)
    got = score(table, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    right = [by[i] == (i % 2 if score is toxicity.score_toxicity else 1 - i % 2) for i in range(60)]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize(("score", "alone"), [(quality.score_quality, 0.5), (toxicity.score_toxicity, 0.0)])
def test_no_labels_and_no_documents(spark, docs, score, alone):
    table, labels, _ = small(spark, docs)
    assert {r.score for r in score(table, labels.limit(0)).collect()} == {alone}
    assert score(docs([]), labels).collect() == []


def test_held_out_labels_are_never_read(spark, docs):
    """Scores stay the same when every held-out label is turned round."""
    table, labels, _ = small(spark, docs)
    turned = [(r.doc_id, *((1 - r.quality, 1 - r.toxic) if held(r.doc_id) else (r.quality, r.toxic))) for r in labels.dropna().collect()]
    turned = spark.createDataFrame(turned, labels.schema)
    for score in (quality.score_quality, toxicity.score_toxicity):
        a, b = ({(r.doc_id, r.score) for r in score(table, x).collect()} for x in (labels.dropna(), turned))
        assert a == b


def test_sample_is_bounded_and_repeatable(spark, docs):
    _, labels, _ = small(spark, docs)
    one = labelled.label_sample(labels, "toxic", 7).collect()
    assert len(one) == 7 and one == labelled.label_sample(labels.repartition(5), "toxic", 7).collect()


def test_temperature_and_threshold():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < labelled.sigmoid(z)).astype(float)
    assert labelled.temperature(z * 3, y) == pytest.approx(3, rel=0.15)
    assert toxicity.best_threshold(np.array([0.2] * 10 + [0.4] * 10), np.array([0] * 10 + [1] * 10)) == pytest.approx(0.4)
    assert toxicity.best_threshold(np.array([0.2, 0.9]), np.array([0, 1])) == 0.5


def test_random_indexing_counts_neighbours():
    """Context counts of a chunked corpus against a double loop."""
    import pyarrow as pa
    texts = ["one two three two", "TWO two!! one", "", "four"]
    index = quality.index_vectors()
    got = np.zeros(quality.BUCKETS * quality.DIM, np.int64)
    quality.context_counts(pa.array([*texts, None]), index, got)
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for t in texts:
        for _, _, data, offs in quality.chunks(pa.array([t])):
            b, _ = quality.token_buckets(data, offs)
            for i in range(len(b)):
                for j in range(max(0, i - quality.WINDOW), min(len(b), i + quality.WINDOW + 1)):
                    if i != j:
                        want[b[i]] += index[b[j]]
    assert (got.reshape(want.shape) == want).all()


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_long_texts_train_too(spark, docs):
    """Every text is longer than the window that training reads of it."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(300):
        words = [f"w{k}" for k in rng.integers(0, 500, toxicity.TRAIN_WORDS + 100)]
        if i % 2:
            for k in rng.choice(len(words), 60, replace=False):
                words[k] = "vile"
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [r for r in toxicity.score_toxicity(docs(rows), labels).collect() if r.held_out]
    assert auc(np.array([r.score for r in got]), np.array([r.doc_id % 2 for r in got])) > 0.9


def test_convolution_and_pooling_against_loops():
    rng = np.random.default_rng(11)
    net = toxicity.Cnn(np.arange(0, 60, 2).astype(np.int32))
    texts = [rng.integers(0, 31, n) for n in (0, 1, 2, 3, 17)]
    first = np.cumsum([0] + [len(t) for t in texts])
    got = net.pooled(np.concatenate(texts), first)
    for t, row in zip(texts, got, strict=True):
        want = []
        for w, f in zip(toxicity.WIDTHS, net.conv, strict=True):
            for c in range(toxicity.FILTERS):
                at = [sum(net.emb[t[p + j]] @ f[j, :, c] for j in range(w) if p + j < len(t)) for p in range(len(t))]
                want.append(max(at, default=0.0))
        np.testing.assert_allclose(row, want, atol=1e-5)


def many_labels(spark, docs, n=600):
    """Only a few rows hold each sign of class 1: what is left unread can't be known."""
    rows = [(i, f"the cat sat on mat {i % 7} " + (f"vile{i // 20} vile{i // 20}" if i % 2 else f"kind{i // 20} kind{i // 20}")) for i in range(n)]
    return docs(rows), spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(n)], "doc_id long, quality int, toxic int")


def test_every_labelled_row_trains(spark, docs, monkeypatch):
    """All rows outside the held-out fold reach the training, whatever a shard's size; each in one shard."""
    monkeypatch.setattr(labelled, "SHARD_ROWS", 100)
    table, labels = many_labels(spark, docs)
    rows = toxicity.labelled_words(table.unionByName(table), labels, "toxic")
    want = [i for i in range(600) if not held(i)]
    assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == want
    assert rows.rdd.getNumPartitions() == -(-len(want) // 100)
    learn = [i for i in want if i not in {r.doc_id for r in rows.filter("left").collect()}]
    assert 0.7 * len(want) < len(learn) < 0.9 * len(want)
    _, counts, toxic = toxicity.word_counts(rows)
    words = {i: {*f"the cat sat on mat {i % 7} {'vile' if i % 2 else 'kind'}{i // 20}".split()} for i in want}
    often = {w for w in set().union(*words.values()) if sum(w in x for x in words.values()) >= toxicity.MIN_DOCS}
    assert sorted(counts) == sorted(sum(w in words[i] for i in learn) for w in often)
    assert sorted(toxic) == sorted(sum(i % 2 for i in learn if w in words[i]) for w in often)
    rows.unpersist()


@pytest.mark.parametrize("shard", [60, 8000])
def test_training_in_shards(spark, docs, monkeypatch, shard):
    """Words that only one class has tell held-out rows apart, from one shard or from many; the same scores again."""
    monkeypatch.setattr(labelled, "SHARD_ROWS", shard)
    table, labels = many_labels(spark, docs)
    for score in (quality.score_quality, toxicity.score_toxicity):
        got = {r.doc_id: r.score for r in score(table, labels).collect()}
        ids = [i for i in got if held(i)]
        y = np.array([i % 2 if score is toxicity.score_toxicity else 1 - i % 2 for i in ids])
        assert auc(np.array([got[i] for i in ids]), y) > 0.95
        again = {r.doc_id: r.score for r in score(table.repartition(3), labels.repartition(2)).collect()}
        assert again == pytest.approx(got, abs=1e-3)


def test_shards_follow_the_rows_not_the_session(spark, docs, monkeypatch):
    """A session that deals keys out to more partitions starts no more tasks in a round; every labelled row is in one shard."""
    monkeypatch.setattr(labelled, "SHARD_ROWS", 100)
    table, labels = many_labels(spark, docs)
    dealt = type(table).repartition
    monkeypatch.setattr(type(table), "repartition", lambda df, n, *cols: dealt(df, max(n, 40) if cols else n, *cols))
    rows = toxicity.labelled_words(table, labels, "toxic")
    want = [i for i in range(600) if not held(i)]
    assert rows.rdd.getNumPartitions() == -(-len(want) // 100)
    assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == want
    rows.unpersist()


def test_a_rounds_means_take_few_tasks(spark):
    """The session's shuffle partitions don't set the tasks of a round; the means are those of numpy."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    cores = spark.sparkContext.defaultParallelism
    values = np.random.default_rng(1).normal(0, 1, (3, 50 * labelled.WIDTH))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = spark.range(0, 3, 1, 3)

        def task(batches):
            for b in batches:
                for i in b.column(0).to_pylist():
                    yield labelled.blocks(0, values[i])

        parts = labelled.arrow_map(rows, task, "row int, " + ", ".join(f"v{k} long" for k in range(labelled.WIDTH)))
        assert labelled.means(parts).rdd.getNumPartitions() <= cores
        at, got = labelled.averages(rows, task)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert at.tolist() == list(range(50))
    np.testing.assert_allclose(got.ravel(), values.mean(axis=0), atol=1e-6)


def test_one_step_on_a_long_text_reads_it_whole(monkeypatch):
    """The largest answers and their places, in pieces and at once."""
    rng = np.random.default_rng(5)
    net = toxicity.Cnn(np.arange(200).astype(np.int32))
    text = rng.integers(0, 201, 5000)
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 10_000)
    once = net.best(text)
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 37)
    pieces = net.best(text)
    np.testing.assert_allclose(once[1], pieces[1], atol=1e-6)
    np.testing.assert_allclose(net.pooled(text, np.array([0, len(text)]))[0], pieces[1], atol=1e-6)
    assert (once[0] == pieces[0]).all()


def test_packed_words_read_back():
    for n in (0, 1, 1000):
        words = np.arange(n, dtype=np.int32) * 7
        assert (toxicity.unpacked(toxicity.packed(words)) == words).all()
