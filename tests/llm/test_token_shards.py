import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockspark.llm import token_shards as T


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 17, 1000, 4097])
def test_permutation(size):
    slots = T.permute(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    assert T.permute(slots, size, back=True).tolist() == list(range(size))
    if size > 100:
        assert not np.array_equal(slots, T.permute(np.arange(size), size, key=1))
        assert abs(np.corrcoef(slots, np.arange(size))[0, 1]) < 0.2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", " \n", "a", "Word", "'s", ".", "12", "é", "漢", "\t", "<|endoftext|>"]), max_size=20).map("".join))
def test_ids_give_the_text_back(text):
    e = T.encoder(T.VOCABULARY)
    ids = np.frombuffer(e.encode(text), e.type).tolist()
    assert ids[-1] == e.end and e.end not in ids[:-1] and e.encoding.decode(ids[:-1]) == text
    assert e.count(text) == len(ids)


def test_round_trip(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = f"file://{tmp_path}/shards"
    rows = T.write_shards(docs, folder, length=128, slots=100).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    ids = T.read_slots(folder, 0, len(rows) + 5, length=128, slots=100)
    assert len(ids) == len(rows)
    e = T.encoder(T.VOCABULARY)
    parts = defaultdict(dict)
    for r in rows:
        assert (r.shard, r.offset) == (r.slot // 100, r.slot % 100 * 256) and r.crc32 == zlib.crc32(ids[r.slot].tobytes())
        assert (ids[r.slot][r.n_tokens :] == e.end).all()
        parts[r.doc_id][r.part] = ids[r.slot][: r.n_tokens].tolist()
    assert set(parts) == set(texts)
    for d, text in texts.items():
        every = [t for k in sorted(parts[d]) for t in parts[d][k]]
        assert every[-1] == e.end and e.encoding.decode(every[:-1]) == text
    assert np.array_equal(T.read_slots(folder, 95, 10, length=128, slots=100), ids[95:105])
    assert not [p for p in (tmp_path / "shards").iterdir() if p.name.startswith(".")]


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "c"), (None, "", "c"), (2, "x " * 5000, "c"), (2, "x " * 5000, "c")], "doc_id long, text string, slot string")
    rows = T.write_shards(df, f"file://{tmp_path}/a").collect()
    assert sorted((r.doc_id or 0, r.part, r.n_tokens) for r in rows)[:2] == [(0, 0, 1), (1, 0, 1)]
    assert len({r.slot for r in rows}) == len(rows) == 2 + 2 * 10
    assert T.write_shards(df.limit(0), f"file://{tmp_path}/b").count() == 0


def test_long_runs_of_white_space(monkeypatch):
    import random
    import re
    import time

    from blockspark.functions import text as X

    held = T.encoder(T.VOCABULARY)
    start = time.time()
    for text in (" " * 1_000_000, "x" + "\n" * 1_000_000 + " y", " \t" * 300_000):
        ids = held.ids(text)
        assert b"".join(held.encoding.decode_single_token_bytes(i) for i in ids).decode() == text
    assert time.time() - start < 60
    # cut at shorter runs, the ids are those of the text as a whole
    monkeypatch.setattr(T, "LONG_SPACE", 2)
    monkeypatch.setattr(X, "LONG_SPACE", 2)
    monkeypatch.setattr(X, "_LONG_RUN", re.compile(f"[{X._WHITE}]{{2,}}"))
    r = random.Random(3)
    for _ in range(5000):
        text = "".join(r.choice([" ", " ", "\n", "\r", "\t", "a", "Ab", "1", "!", "'s", "é", "\x1c", "\u3000", "漢"]) for _ in range(r.randint(0, 14)))
        assert held.ids(text) == held.encoding.encode_ordinary(text)


def test_both_patterns_give_the_same_ids():
    import random

    import tiktoken

    held = T.encoder(T.VOCABULARY)
    # the runs are those of the library's white space
    library = tiktoken.Encoding("white", pat_str=r"\s", mergeable_ranks=held.encoding._mergeable_ranks, special_tokens={})
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    white = [c for c in every if library.encode_ordinary(c)]
    assert [c for c, (_, run) in zip(every, T.texts(pa.array([2 * c for c in every])), strict=True) if run] == white
    r = random.Random(4)
    marks = ["a", "Ab", "1", "!", "'s", "'", "é", "漢", "\x1c", "\x00", "<|endoftext|>", "\U0001f600"]
    spaces = [*white, " ", " ", "\n"]
    mixed = ["".join(r.choice(marks + spaces) for _ in range(r.randint(0, 14))) for _ in range(5000)]
    single = ["".join(r.choice(marks) * r.randint(1, 3) + r.choice(["", *spaces]) for _ in range(r.randint(0, 9))) for _ in range(5000)]
    flagged = list(T.texts(pa.array([*mixed, *single, None, ""])))
    assert [run for _, run in flagged].count(True) > 1000 and [run for _, run in flagged].count(False) > 1000
    for text, run in flagged:
        ids = held.encoding.encode_ordinary(text or "")
        assert held.encode(text, run) == np.array([*ids, held.end], held.type).tobytes() and held.count(text, run) == len(ids) + 1


def test_round_trip_with_and_without_runs(spark, tmp_path):
    texts = [None, "", "a b\nc " * 400, "a  b\n\n c " * 400, "x" + " " * 12_000 + "y", "end \n", "<|endoftext|> <|endoftext|>  z"]
    folder = f"file://{tmp_path}/shards"
    rows = T.write_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folder, length=64, slots=10).collect()
    ids, held = T.read_slots(folder, 0, len(rows), length=64, slots=10), T.encoder(T.VOCABULARY)
    for d, text in enumerate(texts):
        every = [t for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.part) for t in ids[r.slot][: r.n_tokens].tolist()]
        assert every == [*held.encoding.encode_ordinary(text or ""), held.end]


def test_cheaper_than_the_pattern_with_its_look_ahead(spark, sf):
    import time
    from array import array

    held = T.encoder(T.VOCABULARY)
    column = pa.array([r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r.text and "  " not in r.text])
    lists = lambda: [array("H", [*held.encoding.encode_ordinary(t), held.end]).tobytes() for t in column.to_pylist()]
    ours = lambda: [held.encode(*t) for t in T.texts(column)]
    seconds = {lists: [], ours: []}
    for _ in range(5):
        for made in seconds:
            start = time.process_time()
            made()
            seconds[made].append(time.process_time() - start)
    assert lists() == ours() and min(seconds[ours]) < 0.85 * min(seconds[lists])
