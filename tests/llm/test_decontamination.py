import random

from hypothesis import given, settings
from hypothesis import strategies as st

from blockspark.llm import decontamination as D


def plain_tiles(pattern, text, least):
    """Greedy string tiling by trying every pair of places for the longest match, over and over."""
    fp, ft, found = [True] * len(pattern), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                k = 0
                while p + k < len(pattern) and t + k < len(text) and pattern[p + k] == text[t + k] >= 0 and fp[p + k] and ft[t + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, t)
        k, p, t = best
        if k < least:
            return found
        fp[p : p + k] = ft[t : t + k] = [False] * k
        found.append((p, t, k))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=30), st.lists(st.integers(-1, 3), max_size=40), st.integers(1, 4), st.sampled_from([4, 8, 32]))
def test_tiles_same_as_plain_greedy(pattern, text, least, first):
    assert D.tiles(pattern, text, least, first) == plain_tiles(pattern, text, least)


def brute(docs, items):
    """Tile every document with every item."""
    words = {}
    ids = lambda t: [words.setdefault(x, len(words) + 1) for x in D.tokens(t)]
    held = [(i, ids(t)) for i, t in items]
    found = set()
    for d, t in docs:
        text = ids(t)
        for i, item in held:
            n = sum(k for *_, k in D.tiles(item, text))
            if n and n >= D.COVERAGE * len(item):
                found.add((d, i, n))
    return found


def test_index_same_as_all_pairs():
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 25)))) for k in range(12)] + [(99, None), (98, ""), (97, "one two")]
    docs = []
    for d in range(60):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            source = (r.choice(items)[1] or "").split()
            cut = r.randint(0, len(source))
            words += source[cut:] + ["gap"] + source[:cut]
        docs.append((d, " ".join(words)))
    docs += [(100, None), (101, ""), (102, items[0][1].upper())]
    index = D.Index(items)
    got = {(docs[k][0], index.ids[i], n) for k, leaks in enumerate(index.leaks([t for _, t in docs])) for i, n, *_ in leaks}
    assert got == brute(docs, items)


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op1_benchmark_leaks

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 4000]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    small = {d for d, _ in docs}
    got = {(g.doc_id, g.item_id, g.n_covered) for g in op1_benchmark_leaks(spark, sf).collect()}
    assert {g for g in got if g[0] in small} == brute(docs, items)


def test_edges_and_blocks(spark):
    passage = "the quick brown fox jumps over the lazy dog again and again"
    turned = "again and again over the lazy dog THE QUICK brown fox, jumps"
    docs = spark.createDataFrame([(1, passage, "c"), (2, turned, "c"), (3, None, "c"), (4, "", "c"), (None, passage, "c"), (5, "nothing of the kind here " * 9000, "c"), (1, passage, "c")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, passage, "x"), (8, None, "x"), (9, "short one", "x"), (7, passage, "x"), (10, "some other text that nobody ever repeats", "x")], "item_id long, text string, doc_id string")
    for size in (D.BLOCK, 30):
        got = D.find_leaks(docs, items, size=size).collect()
        assert sorted((g.doc_id or 0, g.item_id) for g in got) == [(0, 7)] * 2 + [(1, 7)] * 4 + [(2, 7)] * 2
        kept = D.drop_leaks(docs, items, size=size)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert D.find_leaks(docs, items.limit(0)).count() == 0 and D.find_leaks(docs.limit(0), items).count() == 0
    assert D.drop_leaks(docs, items.limit(0)).count() == 7


def test_long_documents(sf):
    import pyarrow.parquet as pq

    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist() if len(r["text"] or "") >= 4000]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    docs.append((-1, " ".join(t for _, t in docs) + " " + items[0][1]))
    seeds = lambda t: {tuple(w[i : i + D.MIN_MATCH]) for w in [D.tokens(t)] for i in range(len(w) - D.MIN_MATCH + 1)}
    held = [(i, t, seeds(t)) for i, t in items]
    want = set()
    for d, t in docs:
        met = seeds(t)
        want |= brute([(d, t)], [(i, x) for i, x, s in held if s & met])
    index = D.Index(items)
    got = {(docs[k][0], index.ids[i], n) for k, leaks in enumerate(index.leaks([t for _, t in docs])) for i, n, *_ in leaks}
    assert got == want and (-1, items[0][0]) in {g[:2] for g in got}


def test_short_and_unspaced_items():
    items = [(1, "Yes, no!"), (2, "今天天气很好我们去公园玩"), (3, "好"), (4, "yes")]
    index = D.Index(items)
    found = lambda t: [index.ids[i] for i, *_ in index.leaks([t])[0]]
    assert found("well\nyes: No\nmore") == [1] and found("yes no more") == [] and found("yes") == [4]
    assert found("前言：今天天气很好，我们去公园玩。") == [2] and found("今天很好") == [] and found("好") == [3]
    assert index.leaks(["", None, "\n"]) == [[], [], []]


def test_repetition_is_no_blow_up():
    import time

    start = time.time()
    assert D.tiles([1] * 200, [1] * 20_000) == [(0, 0, 200)]
    assert sum(k for *_, k in D.tiles([1, 2] * 150, [1, 2, 1] * 5_000)) <= 300
    assert time.time() - start < 20


def test_blocks_one_at_a_time(spark):
    table = spark.createDataFrame([(k, f"item {k} " * 5) for k in range(50)], "item_id long, text string")
    parts = list(D.blocks(table, size=400))
    assert len(parts) > 3 and sorted(i for part in parts for i, _ in part) == list(range(50))
    assert list(D.blocks(table.limit(0))) == []
