import re

import numpy as np

from blockspark.llm import quality_rules as Q


def exact(x):
    """The same estimate with every distance sorted, on the driver."""
    starts = []
    q = np.percentile(x, [25, 50, 75], axis=0, method="lower")
    for mean, cov in ((q[1], np.diag(np.square((q[2] - q[0]) / 1.349) + np.square(Q.FLOOR))), (x.mean(0), np.cov(x.T, bias=True) + np.diag(np.square(Q.FLOOR)))):
        last = np.inf
        for _ in range(200):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            near = x[np.argsort(d, kind="stable")[: round(Q.HALF * len(x))]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) * Q.consistency(Q.HALF) + np.diag(np.square(Q.FLOOR))
            if last - np.linalg.slogdet(cov)[1] <= 1e-9:
                break
            last = np.linalg.slogdet(cov)[1]
        starts.append((np.linalg.slogdet(cov)[1], mean, cov))
    _, mean, cov = min(starts, key=lambda s: s[0])
    near = x[np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean) <= Q.chi2_quantile(0.975, Q.P)]
    return near.mean(0), np.cov(near.T, bias=True) * Q.consistency(0.975) + np.diag(np.square(Q.FLOOR))


def test_chi_squared():
    assert abs(Q.chi2_quantile(0.975, 7) - 16.0128) < 1e-3
    assert abs(Q.chi2_quantile(0.95, 1) - 3.8415) < 1e-3
    assert abs(Q.chi2_quantile(1e-6, 8, True) - 42.70) < 0.3


def test_binned_steps_near_exact(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(size=(900, Q.P)) * np.array([1, 0.2, 0.3, 0.2, 0.1, 0.1, 0.1]), r.normal(size=(100, Q.P)) * 0.1 + 4])
    df = spark.createDataFrame([("=a", "=b", [float(v) for v in row]) for row in x], "g_lang string, g_source string, x array<double>")
    got = {g.g_source: g for g in Q.robust_estimates(df).collect()}
    mean, cov = exact(x)
    assert set(got) == {"=b", "*"}
    assert np.allclose(got["=b"].m, mean, atol=0.05)
    assert abs(got["=b"].logdet - np.linalg.slogdet(cov)[1]) < 0.5
    assert np.abs(np.array(got["=b"].m)).max() < 0.3  # the far tenth has no pull


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(windows) < 3000 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), None if covered is None else len(covered)


def test_whole_table(spark, sf):
    from blockspark.llm.queries import op8_quality_rules

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op8_quality_rules(spark, sf).collect()
    assert len(got) == len(texts)
    for g in got:
        want = brute(texts[g.doc_id])
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines) == want[:4]
        if want[4] is not None:
            assert g.n_repeat_words == want[4]
        assert g.base_failed == (g.n_words < 10 or 100 * g.n_repeat_words > 20 * g.n_words)
        assert not (g.base_failed and g.kept)
        if labels.get(g.doc_id) == 1 and not g.base_failed:
            assert g.kept


def test_edges(spark):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(1, None, None, None), (2, "", "en", "s"), (2, text, None, "s"), (3, text, "en", None), (4, "w " * 60_000, "en", "s"), (None, text, "*", "*")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, source string, kept string")
    got = Q.digest(Q.judge(df)).collect()
    assert sorted((g.doc_id or -1, g.base_failed, g.kept) for g in got) == sorted([(1, True, False), (2, True, False), (2, False, True), (3, False, True), (4, True, False), (-1, False, True)])
    assert Q.judge(df.limit(0)).count() == 0


def plain(r, n):
    return " ".join("".join(r.choice(list("abcdefghij"), r.integers(3, 9))) for _ in range(n))


def test_small_language_is_judged(spark):
    r = np.random.default_rng(5)
    rows = [(k, plain(r, int(r.integers(40, 200))), "en" if k < 150 else "xx" if k < 170 else None, "s") for k in range(180)]
    junk = " ".join(f"{w} #|$ <{w[:2]}>" for w in plain(r, 60).split())
    rows += [(200, junk, "xx", "s"), (201, junk, None, "s"), (202, junk, "yy", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {g.doc_id: g for g in Q.judge(df).collect()}
    assert len(got) == len(rows) and not any(g.base_failed for g in got.values())
    assert all(g.distance2 is not None for g in got.values())
    assert {d for d, g in got.items() if not g.kept} == {200, 201, 202}


def test_least_counts_all_rows_of_a_group(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(100, Q.P)) * 0.1
    x[:8] += 5
    df = spark.createDataFrame([("=a", "=b", [float(v) for v in row]) for row in x], "g_lang string, g_source string, x array<double>")
    got = {(g.g_lang, g.g_source): g.n for g in Q.robust_estimates(df).collect()}
    assert got == {("=a", "=b"): 100, ("=a", "*"): 100, ("*", "*"): 100}


def test_each_bounded_statistic_alone_can_reject():
    r = np.random.default_rng(7)
    measure = lambda t: (Q.statistics.base(t), Q.vector(t, Q.statistics.base(t)))
    x = np.array([measure("\n".join(plain(r, 8) for _ in range(int(r.integers(5, 300)))))[1] for _ in range(150)])
    lines = [plain(r, 3) for _ in range(100)] * 6
    base, shuffled = measure("\n".join(lines[k] for k in r.permutation(len(lines))))
    assert 100 * base[4] <= 20 * base[0]  # the base rules miss it
    repeats = [*x.mean(0)[:4], 0.195, *x.mean(0)[5:]]
    mean, cov = exact(x)
    for far in (np.array(shuffled), np.array(repeats)):
        assert (far - mean) @ np.linalg.inv(cov) @ (far - mean) > Q.chi2_quantile(Q.TAIL, Q.P, True)


def test_repeats_of_long_texts(sf):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    texts = [*texts, " ".join(texts)]
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts = {}
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
        covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
        assert Q.statistics.base(text)[4] == len(covered)
    assert len(texts[-1].split()) > 3000
