import zlib

import numpy as np

from blockspark.llm import quality_classifier as Q
from blockspark.llm import statistics as S
from blockspark.llm import trees


def slow_margin(forest, row):
    total = forest.start
    for k in forest.roots:
        while np.isfinite(forest.cut[k]):
            k = forest.child[k] + (row[forest.feature[k]] > forest.cut[k])
        total += forest.value[k]
    return total


def test_flat_walk_same_as_node_by_node():
    r = np.random.default_rng(3)
    x = r.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    forest = trees.train(x, y, trees=30)
    test = r.normal(size=(50, 5))
    assert np.allclose(forest.margin(test), [slow_margin(forest, t) for t in test])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9


def test_degenerate_training():
    assert trees.train(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one = trees.train(np.ones((9, 3)), np.ones(9))
    assert (one.score(np.ones((2, 3))) > 0.9).all()


def test_statistics_brute_force():
    text = "a b c d e x a b c d e\nline\nline\n \nA|b #c"
    words = text.split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert S.base(text) == (len(words), sum(map(len, words)), 2, 1, len(covered))
    assert S.base(None) == S.base("") == (0, 0, 0, 0, 0)
    assert all(np.isfinite(S.features(t)).all() for t in (None, "", " \n", "x", "é" * 100_000, "a " * 5000, "\x1c"))


def test_held_out_accuracy(spark, sf):
    from blockspark.llm.queries import op6_quality_classifier

    sf = sf.replace("0.001", "0.01")
    got = op6_quality_classifier(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) and g.predicted == int(g.score >= 0.3) and 0 <= g.score <= 1 for g in got)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(g.predicted, quality[g.doc_id]) for g in got if g.held_out and g.doc_id in quality]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", None), (None, "fine words here", "s"), (2, "x" * 300_000, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0)], "doc_id long, quality int")
    forest = Q.fit(docs, labels)
    assert Q.digest(Q.score(docs, forest)).count() == 4
    assert Q.keep_good(docs, forest).columns == docs.columns
    none = Q.fit(docs.limit(0), labels.limit(0))
    assert {r.score for r in Q.score(docs, none).collect()} == {0.5}
    assert Q.score(docs.limit(0), none).count() == 0
