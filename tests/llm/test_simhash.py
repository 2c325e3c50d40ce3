import random

import xxhash
from pyspark.sql import functions as F

from blockspark.llm import simhash as S


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(fps):
    """fps: {id: fp} -> {id: (n_near, component)} by comparing all."""
    ids = sorted(fps)
    near = {i: [j for j in ids if j != i and (fps[i] ^ fps[j]).bit_count() <= 3] for i in ids}
    comp = {}
    for i in ids:
        if i not in comp:
            todo, seen = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            for j in seen:
                comp[j] = i
    return {i: (len(near[i]), comp[i]) for i in ids}


def test_fingerprint_same_as_brute_force():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 50):
        text = " \t".join(r.choice(["Ab", "cÉ", "x", "\x1cy"]) for _ in range(n))
        assert int.from_bytes(S.fingerprint(text), "big") == brute_fp(text)
    assert S.fingerprint(None) == S.fingerprint(" \n") == bytes(8)


def test_links_and_components(spark):
    r = random.Random(2)
    fps = []
    for _ in range(40):
        fp = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            fps.append(fp)
            for _ in range(r.randint(0, 4)):
                fp ^= 1 << r.randrange(64)
    fps += [0, 0, 1, 7, 15]
    want = brute(dict(enumerate(fps)))
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    classes = df.groupBy("fp").agg(F.count("*").alias("n"))
    got = {(r.a, r.b) for r in S.links(classes).collect()}
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    distinct = sorted(map(sign, set(fps)))
    assert got == {(r.a, r.b) for r in S.links(classes, hot=2).collect()} and S.links(classes, hot=2).count() == len(got)
    assert got == {(a, b) for a in distinct for b in distinct if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    import pytest

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(S, "fingerprints", lambda *_: df)
        rows = S.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_near, r.component_id) for r in rows} == want


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op9_simhash_near_dedup

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: brute_fp(d.text) for d in docs}
    links = brute(want)
    got = op9_simhash_near_dedup(spark, sf).collect()
    assert {(g.doc_id, g.fingerprint, g.n_near, g.component_id) for g in got} == {(i, f"{f:016x}", *links[i]) for i, f in want.items()}


def test_edges(spark):
    df = spark.createDataFrame([(5, None, "z"), (3, "", "z"), (None, " ", "z"), (9, "same words here now", "z"), (9, "same words here now", "z"), (8, "x " * 50_000, "z")], "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.n_near, r.component_id) for r in S.near_duplicates(df).collect())
    assert got == [(-1, 2, 3), (3, 2, 3), (5, 2, 3), (8, 0, 8), (9, 1, 9), (9, 1, 9)]
    assert sorted((r.doc_id or -1) for r in S.keep_one(df).collect()) == [-1, 3, 8, 9]
    assert S.near_duplicates(df.limit(0)).count() == 0
    assert S.keep_one(df).columns == df.columns


def test_keep_one_tells_texts_of_one_id_apart(spark):
    r = random.Random(11)
    a, b = (" ".join(r.choice("abcdefghijklmnop") * r.randint(1, 9) for _ in range(80)) for _ in "ab")
    rows = [(1, a, 7), (5, a, 8), (5, b, 9), (5, b, 9), (None, a, 1)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string, __nth int").repartition(parts)
        got = S.keep_one(df)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, a, 7), (5, b, 9), (None, a, 1)], key=repr)


def test_large_family_shares_keys(spark):
    r = random.Random(8)
    base = r.getrandbits(64)
    family = {base ^ sum(1 << b for b in r.sample(range(40), r.randint(0, 5))) for _ in range(600)}
    sign = lambda f: f - (1 << 64) if f >> 63 else f
    classes = spark.createDataFrame([(sign(f), 1) for f in family], "fp long, n long")
    want = {tuple(sorted((sign(x), sign(y)))) for x in family for y in family if x < y and (x ^ y).bit_count() <= 3}
    found = [(x.a, x.b) for x in S.links(classes, hot=50).collect()]
    assert len(found) == len(set(found)) and set(found) == want
