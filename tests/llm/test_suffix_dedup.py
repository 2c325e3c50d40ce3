import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockspark.llm import suffix_dedup as S


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=12, max_size=12).map(bytes), max_size=40))
def test_blind_trie_sorts(strings):
    assert [strings[i] for i in S.blind_trie(strings)] == sorted(strings)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), min_size=19, max_size=19), min_size=1, max_size=60), st.sampled_from([0, 8, 16, 24]))
def test_deep_shallow_sorts(rows, shallow):
    matrix = np.array(rows, np.uint8)
    order = S.deep_shallow(matrix, shallow)
    assert sorted(order.tolist()) == list(range(len(rows)))
    assert [rows[i] for i in order] == sorted(rows)


def brute(docs, length):
    """docs: (id, text) in any order, ids unlike. Marks every window whose bytes were met before."""
    met, out = set(), {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in met:
                gone[p : p + length] = True
            met.add(w)
        gone = gone[:-1]
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[d] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def planted(r, alphabet, n, longest):
    pool = ["".join(r.choice(alphabet) for _ in range(r.randint(5, longest))) for _ in range(6)]
    docs = []
    for d in r.sample(range(1000), n):
        parts = []
        for _ in range(r.randint(0, 6)):
            part = r.choice(pool)
            cut = r.randint(0, len(part))
            parts.append(r.choice([part, part[cut:], part[:cut], "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))]))
        docs.append((d, "".join(parts)))
    return docs


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("abcdefgh", 2), ("é漢a\x00b", 3), ("a", 4)])
def test_short_strings_same_as_brute_force(spark, alphabet, seed):
    docs = planted(random.Random(seed), alphabet, 40, 90)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {g.doc_id: (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in S.digest(S.repeated_spans(df, length=20, gram=8, parts=3)).collect()}
    assert got == brute(docs, 20)


def test_segments_same_as_brute_force(spark, monkeypatch):
    docs = planted(random.Random(9), "abc de", 30, 900)
    monkeypatch.setattr(S, "SEGMENT", 300)
    monkeypatch.setattr(S, "GATHERED", 50)
    finder = S.Anchors(20, 8)
    texts = [t.encode() for _, t in docs]
    which, a, left, right, *_ = finder.of(texts)
    met = [set() for _ in texts]
    for w, x, lo, hi in zip(which.tolist(), a.tolist(), left.tolist(), right.tolist(), strict=True):
        new = set(range(x - lo, x - hi + 1))
        assert not met[w] & new
        met[w] |= new
    assert all(m == set(range(max(0, len(t) - 19))) for m, t in zip(met, texts, strict=True))


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op3_suffix_dedup

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {g.doc_id: (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in op3_suffix_dedup(spark, sf).collect()}
    assert got == brute(docs, 100)


def test_edges(spark):
    r = random.Random(1)
    long = "".join(r.choice("abcdef ") for _ in range(300))
    rows = [(1, None), (2, ""), (3, "x"), (4, long), (4, long), (4, "other " + long), (None, long), (7, "z" * 5000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, spans string")
    got = sorted((g.doc_id or 99, g.n_bytes, g.n_removed) for g in S.digest(S.repeated_spans(df, parts=2)).collect())
    assert got[:3] == [(1, 0, 0), (2, 0, 0), (3, 1, 0)]
    assert got[3:5] == [(4, 300, 0), (4, 300, 0)] and got[-1] == (99, 300, 300)
    assert got[5] == (4, 306, 300) and got[6] == (7, 5000, 4999)
    assert S.repeated_spans(df.limit(0), parts=2).count() == 0


def test_ties_get_the_verdict_of_their_head(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdef ") for _ in range(n))
    header, other = text(300), text(300)
    rows = [(1, header + "1" + text(200)), (2, "2" + other[:200] + "3" + text(200))]
    rows += [(None, header + c + text(200)) for c in "45"] + [(9, other + c + text(200)) for c in "67"]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")  # two rows a task
    for table in (df, df.repartition(6), df.coalesce(1)):
        got = sorted((g.doc_id or 99, g.n_removed) for g in S.digest(S.repeated_spans(table, parts=2)).collect())
        assert got == [(1, 0), (2, 0), (9, 200), (9, 200), (99, 300), (99, 300)]
