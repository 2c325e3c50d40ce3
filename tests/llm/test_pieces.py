import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from blockspark.llm import pieces as P

TEXT = st.lists(st.sampled_from([" ", "  ", "\n", "the", "a", "er", "ing", "ñ", "é", "漢", "▁", "😀", "x", "tion", ".", "\x00", "Th", "　"]), max_size=9).map("".join)


def every(held, points):
    """All segmentations by recursion."""
    if not points:
        return [(0.0, ())]
    found = []
    for k in range(1, len(points) + 1):
        if tuple(points[:k]) in held.scores:
            i, s = held.scores[tuple(points[:k])]
            found += [(s + rest, (i, *ids)) for rest, ids in every(held, points[k:])]
    if tuple(points[:1]) not in held.scores:
        found += [(held.unknown + rest, (*held.spell(points[0]), *ids)) for rest, ids in every(held, points[1:])]
    return found


def whole(text):
    return [c for w in text.split(" ") for c in P.Pieces.points(w)]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_best_same_as_all_segmentations(text):
    held = P.pieces(P.MODEL)
    if not text or len(text) > 14:
        return
    want = sorted((s for s, _ in every(held, whole(text))), reverse=True)[:4]
    words, parts, best = held.encode(text, 4)
    assert np.allclose([s for s, _ in best], want)
    assert len({P.joined(parts, c) for _, c in best}) == len(best)
    known = dict((ids, s) for s, ids in every(held, whole(text)))
    for s, c in best:
        ids = tuple(np.frombuffer(P.joined(parts, c), "<i4").tolist())
        assert abs(known[ids] - s) < 1e-6
        assert held.decode(P.joined(parts, c)) == text
    assert np.allclose([s for s, _ in held.search(whole(text), 4)], want)


def test_numpy_same_as_one_by_one():
    held = P.pieces(P.MODEL)
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghinorstéñ") for _ in range(r.randint(0, 30))) for _ in range(500)] + ["", "▁", "漢字", "a" * 24, "a" * 25]
    held.solved.clear()
    held.solve(list(dict.fromkeys(words)))
    for w in words:
        ids, score, loss = held.alone(w)
        got = held.solved[w]
        assert got[0] == ids and abs(got[1] - score) < 1e-6 and (got[2] == loss or abs(got[2] - loss) < 1e-6)


def test_long_text_same_as_one_search():
    held = P.pieces(P.MODEL)
    text = "The and attion to thanedble the, anea. Eriner  thanea.\nÉoi ciónñ"
    want = [s for s, _ in held.search(whole(text), 6)]
    assert np.allclose([s for s, _ in held.encode(text, 6)[2]], want)


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op4_piece_encoding

    got = op4_piece_encoding(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(texts) and all(g.round_trip for g in got)
    assert all(list(g.best_scores) == sorted(g.best_scores, reverse=True) for g in got)
    held = P.pieces(P.MODEL)
    for g in got:
        if len(texts[g.doc_id]) < 400:
            assert np.allclose(g.best_scores, [s for s, _ in held.search(whole(texts[g.doc_id]), P.BEST)])


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "c"), (None, "", "c"), (2, "▁ x\x00 ­", "c"), (3, "ab " * 40_000, "c"), (3, "y" * 3000, "c")], "doc_id long, text string, ids string")
    got = P.encoded(df, with_ids=True).collect()
    assert all(g.round_trip for g in got) and sorted(g.n_pieces for g in got)[:2] == [0, 0]
    back = P.decode(P.encoded(df, with_ids=True)).collect()
    assert sorted(r.text for r in back) == sorted(r.text or "" for r in df.collect())
    assert P.encode(df.limit(0)).count() == 0
    # the lattice of this text has only two ways through, that of the others more than three
    assert len(P.encode(df.filter("doc_id = 2"), 3).first().segmentations) == 2
    assert {len(r.segmentations) for r in P.encode(df.filter("doc_id = 3"), 3).collect()} == {3}


def test_repetitive_words_take_linear_time():
    import time

    held = P.Pieces(P.MODEL)
    start = time.time()
    for word in ("a" * 100_000, "ab" * 20_000, "漢字" * 5_000):
        _, parts, best = held.encode(word, 4)
        assert held.decode(b"".join(parts)) == word
        assert all(held.decode(P.joined(parts, c)) == word for _, c in best)
        assert not held.solved and not held.lists  # such words aren't remembered
    assert time.time() - start < 60


def proto():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(P.MODEL, "rb") as file:
        model.ParseFromString(file.read())
    return model


def test_pieces_of_white_space_same_as_library():
    import sentencepiece

    held, model = P.Pieces(P.MODEL), proto()
    # the library's lattice is for unigram models, so the same pieces and scores are declared one
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    normal = [i for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
    assert {tuple(map(ord, library.id_to_piece(i))) for i in normal} == set(held.scores)
    weight = lambda i: held.unknown if library.is_byte(i) else library.get_score(i)
    for text in ("a b", "a  b", "a    b", " x", "x ", "  the   cat  ", "x\n        return y\n\n    z", " " * 40, " " * 24 + "else:" + " " * 9 + "a"):
        want = sorted((sum(map(weight, ids)) for ids in library.nbest_encode(text, nbest_size=4, out_type=int)), reverse=True)
        words, parts, best = held.encode(text, 4)
        # the library adds in single precision, so it may miss the best by a little
        assert np.allclose([s for s, _ in best], want, rtol=1e-6) and all(s >= w for (s, _), w in zip(best, want, strict=True)), text
        assert np.allclose([s for s, _ in held.search(whole(text), 4)], [s for s, _ in best])
        for _, c in best:
            assert held.decode(P.joined(parts, c)) == text
    assert len(b"".join(held.encode("a" + " " * 17 + "b")[1])) // 4 == 3


def test_long_runs_of_spaces_take_linear_time():
    import time

    held = P.Pieces(P.MODEL)
    start = time.time()
    for text in (" " * 100_000, "x" + " " * 200_001 + "y", ("    " * 30 + "z\n") * 500):
        _, parts, best = held.encode(text, 4)
        assert len(best) == 4 and all(held.decode(P.joined(parts, c)) == text for _, c in best)
        assert len(b"".join(parts)) // 4 < len(text) / 10
    assert time.time() - start < 60


def test_runs_of_spaces_in_the_query(spark, tmp_path):
    from blockspark.llm.queries import op4_piece_encoding

    texts = ["def f():\n        return  1\n", "   ", "a  b", "a b", " " * 5000, "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op4_piece_encoding(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) and all(g.round_trip for g in got.values())
    held = P.pieces(P.MODEL)
    for k, text in enumerate(texts[:5]):
        assert np.allclose(got[k].best_scores, [s for s, _ in held.search(whole(text), P.BEST)])
    # 5,001 space marks in pieces of 16 at most
    assert [got[k].n_pieces for k in range(1, 7)] == [1, 3, 2, 313, 0, 0]


def test_vocabulary_with_pieces_across_words(tmp_path):
    model = proto()
    across = next(i for i, p in enumerate(model.pieces) if p.piece == "▁of")
    model.pieces[across].piece = "▁of▁the"
    (tmp_path / "across.model").write_bytes(model.SerializeToString())
    held = P.Pieces(str(tmp_path / "across.model"))
    for text in ("of the of", "top of the of  the hill, and all of the others"):
        words, parts, best = held.encode(text, 4)
        assert words == [text] and across in np.frombuffer(parts[0], "<i4")
        assert np.allclose([s for s, _ in best], [s for s, _ in held.search(whole(text), 4)])
        assert all(held.decode(P.joined(parts, c)) == text for _, c in best)
