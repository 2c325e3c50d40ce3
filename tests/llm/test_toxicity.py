import zlib

import numpy as np
import pytest

from blockspark.llm import toxicity as T


def test_windows_keep_every_byte():
    assert T.windows("Ab, (cd) \x1ce ab É!") == sorted([b"ab", b"cd", b"\x1ce", "é".encode()])
    assert T.windows(None) == T.windows(" ") == T.windows("!! ..") == []
    long = "".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) for i in range(500))
    held = T.windows(long)
    assert max(map(len, held)) == T.WIDEST
    # any string of up to STRIDE bytes is whole in some window
    assert all(any(long[i : i + T.STRIDE].encode() in w for w in held) for i in range(len(long) - T.STRIDE + 1))


def test_differences_see_what_only_the_toxic_dictionary_holds():
    d = T.Differences(b" the house of green ", b" wretchedly moronic ")
    d.prepare([[b"wretchedly", b"house", b"green", b"moronic"]])
    assert d[b"wretchedly"] >= 3 and d[b"moronic"] >= 2 and d[b"house"] <= 1 and d[b"green"] <= 1


def test_trained_dictionaries_are_separate():
    r = np.random.default_rng(1)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u")]
    word = lambda: "".join(r.choice(syllables, r.integers(1, 5)))
    texts, y = [], []
    for k in range(300):
        words = [word() for _ in range(120)]
        if k % 4 == 0:
            for at in r.integers(0, 120, 4):
                words[at] = ("wretchkin", "scoundrelly", "vilezort")[at % 3]
        texts.append(T.windows(" ".join(words)))
        y.append(int(k % 4 == 0))
    model = T.learn(texts, np.array(y))
    assert b"wretchkin" not in model.ordinary and b"vilezort" not in model.ordinary
    assert all(w in model.toxic for w in (b"wretchkin", b"scoundrelly", b"vilezort"))
    fresh = [" ".join([word() for _ in range(100)] + more) for more in ([], ["wretchkin", "vilezort"], [])]
    p = T.probabilities(fresh, model, T.Differences(model.ordinary, model.toxic))
    assert p[1] > 0.5 > max(p[0], p[2])


@pytest.fixture(scope="module")
def model(spark, sf):
    folder = sf.replace("0.001", "0.1")
    return T.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def test_same_as_brute_force(spark, sf, model):
    """Every window of every text of a whole table compressed by itself, nothing remembered."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    alone, both = T.Lengths(model.ordinary).compressor, T.Lengths(model.ordinary + model.toxic).compressor
    for r in docs.collect():
        words = {w.strip(T.MARKS) for w in (r.text or "").lower().encode().split()} - {b""}
        parts = [w[i : i + T.WIDEST] for w in words for i in range(0, len(w), T.STRIDE) if i == 0 or i + T.WIDEST - T.STRIDE < len(w)]
        d = [len(alone.compress(T.BEFORE + w + T.AFTER)) - len(both.compress(T.BEFORE + w + T.AFTER)) for w in set(parts)]
        x = [np.log1p(sum(v >= t for v in d)) for t in T.THRESHOLDS] + [np.log1p(len(d)), min(max([0, *d]), 15)]
        z = (np.array(x) - model.centre) / model.scale @ model.weights[:-1] + model.weights[-1]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-9


def test_held_out(spark, sf, model):
    sf = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = T.digest(T.score(docs, model)).collect()
    assert len(got) == docs.count()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) and g.predicted == int(g.score >= 0.5) and 0 <= g.score <= 1 for g in got)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = np.array([(g.predicted, toxic[g.doc_id]) for g in got if g.held_out and g.doc_id in toxic])
    assert held[held[:, 1] == 1, 0].mean() > 0.5
    assert held[held[:, 1] == 0, 0].mean() < 0.02


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", None), (None, "fine words here", "s"), (2, "x" * 300_000, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0)], "doc_id long, toxic int")
    assert T.digest(T.score(docs, T.fit(docs, labels))).count() == 4
    none = T.fit(docs.limit(0), labels.limit(0))
    assert {r.score for r in T.score(docs, none).collect()} == {0.5}
    assert T.score(docs.limit(0), none).count() == 0
    both = T.fit(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int"))
    assert T.score(docs, both).count() == 4
