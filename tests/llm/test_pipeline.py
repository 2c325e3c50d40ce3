import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from blockspark.llm import pieces, secrets
from blockspark.llm.decontamination import MIN_MATCH, tokens
from blockspark.llm.queries import op6_quality_classifier
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_simhash import brute as brute_links
from tests.llm.test_simhash import brute_fp


def test_run_same_as_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r.doc_id for r in op6_quality_classifier(spark, sf).collect() if r.predicted}
    kept = {d: t for d, t in docs.items() if d in good}
    links = brute_links({d: brute_fp(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if links[d][1] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in brute_leaks([(d, t) for d, t in kept.items() if len(t) < 8000], items)}
    want = {}
    for d, t in kept.items():
        if d not in leaked:
            parts, past = [], 0
            for start, end, _ in sorted(sum(secrets.scan(t), [])):
                if start >= past:
                    parts += [t[past:start], "[SECRET]"]
                past = max(past, end)
            want[d] = "".join([*parts, t[past:]])
    got = corpus_pipeline.run(spark, sf).collect()
    held = pieces.pieces(pieces.MODEL)
    long = {d for d, t in kept.items() if len(t) >= 8000}
    assert {g.doc_id for g in got} - long == set(want) - long
    for g in got:
        assert g.round_trip and held.decode(np.array(g.ids, "<i4").tobytes()) == want[g.doc_id]


def test_stages_keep_columns_and_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).schema.names == docs.schema.names, name
        assert stage(spark, docs, sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0


def test_long_documents_lose_leaks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) >= 8000")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaky = docs.withColumns({"doc_id": F.col("doc_id") + 1_000_000, "text": F.concat("text", F.lit(" " + items[0][1]))})
    table = docs.unionByName(leaky)
    seeds = lambda t: {tuple(w[i : i + MIN_MATCH]) for w in [tokens(t)] for i in range(len(w) - MIN_MATCH + 1)}
    held = [(i, t, seeds(t)) for i, t in items]
    want = set()
    for r in table.collect():
        met = seeds(r.text)
        if not brute_leaks([(r.doc_id, r.text)], [(i, t) for i, t, s in held if s & met]):
            want.add(r.doc_id)
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, table, sf).collect()}
    assert docs.count() > 0 and got == want and max(want) < 1_000_000
