"""Toxicity: compressed lengths of windows under dictionaries trained on ordinary and on toxic text.

zstandard's trainer makes one dictionary of ordinary and one of toxic text, each from
its own windows only. A window is a word with a space on both sides; its two compressed
lengths, with the ordinary dictionary alone and with the toxic one behind it, differ by
the bytes that only toxic text explains. (A toxic document is ordinary language with a
few toxic words, so a toxic dictionary alone would have to learn the language again.)

Which windows of a toxic document are the toxic ones isn't labelled. So training goes in
ROUNDS over FOLDS of the labelled documents: dictionaries of the other folds compress a
fold's windows, those whose difference exceeds what nearly all ordinary windows reach are
the toxic text of the next round, and ordinary windows that exceed it too are trained
into the ordinary dictionary. No word is ever weighed by its counts.

A document's distinct windows are counted at each difference of THRESHOLDS; a logistic
regression on the differences of the last round, each from dictionaries that have not
seen the document, sets what counts as toxic. Its probability is the score.

Null texts count as empty, and empty texts get a score. Words of any length are cut
into overlapping windows of WIDEST bytes, and every word of every text counts; order and
repetition within a text don't. Ids may be null (never learnt from) or repeated (each row
is scored; the row with the least text is learnt from); null labels are ignored; without
any label, or with one class only, the score follows the share of that class. Other
columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import held_out, map_batches
from blockspark.llm.quality_classifier import labelled_sample

#: Labelled documents to learn from, about; bytes of each dictionary, of ordinary windows that looked toxic, and the share of its training text that a toxic one may fill.
SAMPLE, ORDINARY, TOXIC, DOUBTFUL, SHARE = 8_000, 1 << 17, 1 << 14, 1 << 16, 0.4
#: Folds and rounds of training; the share of ordinary windows that stays below the cut.
FOLDS, ROUNDS, USUAL = 8, 4, 0.998
#: Compression: the level, the shortest match; the trainer's segment and string lengths, and bytes of a training sample.
LEVEL, MATCH, SEGMENT, STRING, PIECE = 13, 4, 32, 6, 1000
#: A run that both dictionaries end with and every window starts with, so that no block is ever stored raw; a tail that gives the matcher room to look ahead.
BEFORE, AFTER = bytes(range(128, 192)) + b" ", b" " + bytes(range(192, 204))
#: Bytes of a window, and how far the next window of a long word starts after it.
WIDEST, STRIDE = 48, 24
#: Windows count at each of these differences in length.
THRESHOLDS = tuple(range(1, 11))
#: Windows whose difference a task remembers.
REMEMBERED = 400_000
MARKS = b".,!?;:\"'()|#$%&*"


@dataclass(frozen=True)
class Model:
    """Contents of the dictionaries and the regression's weights."""

    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def windows(text: str | None) -> list[bytes]:
    """The distinct lower-case words without the marks around them, sorted; long ones in overlapping parts."""
    if not text:
        return []
    words = {w.strip(MARKS) for w in text.lower().encode("utf-8", "surrogatepass").split()}
    words.discard(b"")
    if max(map(len, words), default=0) > WIDEST:
        words = {w[i : i + WIDEST] for w in words for i in range(0, max(1, len(w) - WIDEST + STRIDE), STRIDE)}
    return sorted(words)


def train(texts: list[list[bytes]], size: int, share: float = 1.0) -> bytes:
    """A dictionary of at most ``size`` bytes trained on documents' windows; too short a text is its own dictionary.

    The trainer goes through its text part by part, takes the best of each, and stops where
    several in a row bring nothing new. So a document's windows stay together (a rare
    language gets its parts), while documents, and windows within one, are mixed.
    """
    mix = np.random.default_rng(20)
    text = [texts[k][i] for k in mix.permutation(len(texts)).tolist() for i in mix.permutation(len(texts[k])).tolist()]
    if not text:
        return b""
    raw = b" " + b" ".join(text) + b" "
    size = int(min(size, max(256, len(raw) * share)))
    piece = max(100, min(PIECE, len(raw) // 20))
    try:
        return zstandard.train_dictionary(size, [raw[i : i + piece] for i in range(0, len(raw), piece)], k=SEGMENT, d=STRING, f=20, accel=1, level=3).as_bytes()
    except zstandard.ZstdError:
        return raw[-size:]


class Lengths:
    """Compressed lengths of windows with one dictionary."""

    def __init__(self, content: bytes, threads: int = 0):
        held = zstandard.ZstdCompressionDict(content + BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=128, dict_size=ORDINARY, min_match=MATCH, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held.precompute_compress(compression_params=parameters)
        self.compressor, self.threads = zstandard.ZstdCompressor(dict_data=held, compression_params=parameters), threads

    def __call__(self, some: list[bytes]) -> np.ndarray:
        out = np.zeros(len(some), np.int32)
        for s in range(0, len(some), 50_000):
            held = self.compressor.multi_compress_to_buffer([BEFORE + w + AFTER for w in some[s : s + 50_000]], threads=self.threads)
            out[s : s + len(held)] = [len(held[i]) for i in range(len(held))]
        return out


class Differences(dict):
    """Window to the bytes by which the toxic dictionary shortens it; kept for REMEMBERED windows."""

    def __init__(self, ordinary: bytes, toxic: bytes, threads: int = 0):
        super().__init__()
        self.alone, self.both = Lengths(ordinary, threads), Lengths(ordinary + toxic, threads)

    def prepare(self, texts: list[list[bytes]]) -> None:
        new = list(set(chain.from_iterable(texts)) - self.keys())
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set(chain.from_iterable(texts)))
        if new:
            self.update(zip(new, (self.alone(new) - self.both(new)).tolist(), strict=True))

    def of(self, some: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, some), np.int64, len(some))


def shape(d: np.ndarray) -> list[float]:
    """Logarithms of the windows at each threshold and of all, and the largest difference."""
    counts = np.bincount(np.clip(d, 0, THRESHOLDS[-1]), minlength=THRESHOLDS[-1] + 1)[::-1].cumsum()[::-1]
    return [*np.log1p(counts[THRESHOLDS[0] :]).tolist(), math.log1p(len(d)), float(min(d.max(initial=0), 15))]


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the intercept last) by Newton's method."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) / len(y) + ridge * w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w)), slope)
    return centre, scale, w


def learn(texts: list[list[bytes]], y: np.ndarray, threads: int = -1) -> Model:
    """Dictionaries and weights from the windows of labelled documents."""
    wide = len(THRESHOLDS) + 2
    if not len(texts):
        return Model(b"", b"", np.zeros(wide), np.ones(wide), np.zeros(wide + 1))
    fold = np.array([zlib.crc32(b" ".join(t)) % FOLDS for t in texts])
    plain: dict[int, bytes] = {}
    toxic: list[list[bytes]] = [t if k else [] for t, k in zip(texts, y, strict=True)]
    doubtful: list[set[bytes]] = [set() for _ in texts]
    found = [np.zeros(len(t), np.int64) for t in texts]

    def dictionaries(f: int) -> tuple[bytes, bytes]:
        """Those of all folds but ``f``."""
        use = np.flatnonzero(fold != f)
        if f not in plain:
            plain[f] = train([texts[k] for k in use if not y[k]], ORDINARY)
        return train([sorted(doubtful[k]) for k in use], DOUBTFUL, 0.5) + plain[f], train([toxic[k] for k in use], TOXIC, SHARE)

    for _ in range(ROUNDS):
        for f in range(FOLDS):
            here = np.flatnonzero(fold == f)
            differences = Differences(*dictionaries(f), threads)
            for s in range(0, len(here), 1000):
                part = here[s : s + 1000]
                differences.prepare([texts[k] for k in part])
                for k in part:
                    found[k] = differences.of(texts[k])
        cut = max(0, int(np.quantile(np.concatenate([np.zeros(1, np.int64), *[found[k] for k in np.flatnonzero(y == 0)]]), USUAL)))
        for k, t in enumerate(texts):
            over = [t[i] for i in np.flatnonzero(found[k] > cut)]
            if y[k]:
                toxic[k] = over
            else:
                doubtful[k].update(over)
    x = np.array([shape(d) for d in found])
    return Model(*dictionaries(-1), *regression(x, y.astype(float)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> Model:
    """Dictionaries and weights from a sample of about ``size`` documents; only its windows reach the driver."""

    def run(batch: pa.RecordBatch) -> list:
        return [batch.column(2), [windows(t) for t in batch.column(1).to_pylist()]]

    rows = map_batches(labelled_sample(docs, labels, label, size).select("doc_id", "text", "y"), run, "y int, w array<binary>", text=1).toArrow()
    # copies count once; the order is that of the windows, so it doesn't depend on the partitions
    seen = sorted({(tuple(w), y) for y, w in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)})
    return learn([list(w) for w, _ in seen], np.array([y for _, y in seen], dtype=np.int64))


def probabilities(texts: list[str | None], model: Model, differences: Differences) -> np.ndarray:
    held = [windows(t) for t in texts]
    differences.prepare(held)
    x = np.array([shape(differences.of(w)) for w in held], dtype=float).reshape(len(texts), len(THRESHOLDS) + 2)
    return 1 / (1 + np.exp(-np.clip((x - model.centre) / model.scale @ model.weights[:-1] + model.weights[-1], -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""

    def run(batch: pa.RecordBatch, differences: Differences) -> list:
        return [batch.column(0), pa.array(probabilities(batch.column(1).to_pylist(), model, differences))]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, score double", text=1, setup=lambda: Differences(model.ordinary, model.toxic))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
