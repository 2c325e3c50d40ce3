"""Benchmark decontamination: greedy string tiling of documents against test items.

Texts are runs of letters and digits in lower case, scripts without spaces being cut
into characters. A seed is a run of MIN_MATCH tokens that an item holds; documents meet the items whose seeds they share. The tokens of an
item that any shared seed covers bound what tiles can cover, so pairs below the
threshold go at once. For the others greedy string tiling marks the longest matches
first and never uses a token twice, finding them by running Karp-Rabin hashes of
halving length. A pair whose tiles cover at least COVERAGE of the item is a leak, in
whatever order its passages stand.

The items are sent to the executors in blocks of at most BLOCK characters, each block
being held against all documents; a larger table of items makes more blocks, of which
the driver holds one at a time. An item shorter than a seed leaks into a document that
has it, and nothing else, on a line. Items that are null or without a token match
nothing; null and empty documents match nothing; long documents are taken whole; repeated rows, of either table, are rows each.
Ids may be null. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches

#: Tokens a tile has at least, share of an item's tokens that tiles of a leak cover, characters of items that are broadcast at once.
MIN_MATCH, COVERAGE, BLOCK = 4, 0.4, 32_000_000
#: Length of the first search; it is halved down to MIN_MATCH.
FIRST_SEARCH = 32
#: Han, kana, Thai, Lao, Burmese and Khmer are written without spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
_TOKEN = re.compile(rf"[^\W{_UNSPACED}]+|[{_UNSPACED}]")
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def _hashes(ids: list[int], free: list[bool], length: int) -> list[tuple[int, int]]:
    """(place, hash) of each run of free tokens of that length, rolling."""
    found, value, run = [], 0, 0
    top = pow(_BASE, length, _PRIME)
    for i, t in enumerate(ids):
        if not free[i] or t < 0:
            value = run = 0
            continue
        value = (value * _BASE + t + 1) % _PRIME
        run += 1
        if run > length:
            value = (value - (ids[i - length] + 1) * top) % _PRIME
        if run >= length:
            found.append((i - length + 1, value))
    return found


def tiles(pattern: list[int], text: list[int], least: int = MIN_MATCH, first: int = FIRST_SEARCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in pattern, place in text, length), longest first.

    Tokens below zero never match. Matches of one length are taken by their places.
    """
    free_p, free_t = [True] * len(pattern), [True] * len(text)
    found: list[tuple[int, int, int]] = []
    search = max(first, least)
    whole_p, whole_t = np.array(pattern, dtype=np.int64), np.array(text, dtype=np.int64)
    while True:
        places: dict[int, list[int]] = {}
        for place, value in _hashes(text, free_t, search):
            places.setdefault(value, []).append(place)
        table = {value: np.array(ts) for value, ts in places.items()}
        open_p, open_t = np.append(free_p, False), np.append(free_t, False)
        queue: list[tuple[int, int, int]] = []
        for p, value in _hashes(pattern, free_p, search):
            ts = table.get(value)
            if ts is None:
                continue
            # a match that could begin further left is part of that one
            if p and open_p[p - 1] and pattern[p - 1] >= 0:
                ts = ts[~((ts > 0) & open_t[ts - 1] & (whole_t[ts - 1] == pattern[p - 1]))]
            k = np.zeros(len(ts), np.int64)
            going = np.arange(len(ts))
            n = 0
            while len(going) and p + n < len(pattern) and open_p[p + n] and pattern[p + n] >= 0:
                at = ts[going] + n
                going = going[open_t[np.minimum(at, len(text))] & (whole_t[np.minimum(at, len(text) - 1)] == whole_p[p + n])]
                n += 1
                k[going] = n
            queue += [(-m, p, t) for t, m in zip(ts.tolist(), k.tolist(), strict=True) if m >= search]
        heapq.heapify(queue)
        if queue and -queue[0][0] > 2 * search:
            search = -queue[0][0]  # a much longer match exists: its like come first
            continue
        while queue:
            negative, p, t = heapq.heappop(queue)
            free = [a and b for a, b in zip(free_p[p : p - negative], free_t[t : t - negative], strict=True)]
            if all(free):
                free_p[p : p - negative] = free_t[t : t - negative] = [False] * -negative
                found.append((p, t, -negative))
            else:  # what longer tiles left of it goes back
                start = 0
                for k, f in enumerate([*free, False]):
                    if not f:
                        if k - start >= search:
                            heapq.heappush(queue, (start - k, p + start, t + start))
                        start = k + 1
        if search == least:
            return found
        search = search // 2 if search > 2 * least else least


class Index:
    """Seeds of a block of items, for vectorised look-up."""

    def __init__(self, items: list[tuple[object, str | None]], least: int = MIN_MATCH):
        self.least = least
        self.ids = [i for i, _ in items]
        words: dict[str, int] = {}
        self.items = [[words.setdefault(t, len(words) + 1) for t in tokens(text)] for _, text in items]
        self.words = words
        #: items too short for a seed, by their tokens
        self.short: dict[tuple[str, ...], list[int]] = {}
        for i, (_, text) in enumerate(items):
            if 0 < len(self.items[i]) < least:
                self.short.setdefault(tuple(tokens(text)), []).append(i)
        places = [(seed, i, p) for i, item in enumerate(self.items) for p, seed in enumerate(self._seeds(np.array(item, dtype=np.int64)).tolist())]
        places.sort()
        rows = np.array(places, dtype=np.uint64).reshape(-1, 3)
        self.seeds, starts = np.unique(rows[:, 0], return_index=True)
        self.starts = np.append(starts, len(rows)).astype(np.int64)
        self.item, self.place = rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64)
        self.sizes = np.array([len(x) for x in self.items], dtype=np.int64)

    def _seeds(self, ids: np.ndarray) -> np.ndarray:
        """A hash of each run of ``least`` ids; equal runs have equal hashes, tiles compare the tokens."""
        n = len(ids) - self.least + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(self.least):
            out = (out ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def leaks(self, texts: list[str | None], coverage: float = COVERAGE) -> list[list[tuple[int, int, int, int]]]:
        """For each text its leaked items: (item, tokens covered, tiles, longest tile)."""
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if self.short:
            for rows, text in zip(found, texts, strict=True):
                lines = {tuple(tokens(line)) for line in (text or "").split("\n")}
                rows += [(i, len(line), 1, len(line)) for line in sorted(lines & self.short.keys()) for i in self.short[line]]
        if not len(self.seeds):
            return found
        get = self.words.get
        parts = [np.fromiter(map(get, tokens(t), repeat(0)), np.int64) for t in texts]
        gap = np.zeros(self.least, np.int64)
        ids = np.concatenate([x for p in parts for x in (p, gap)])
        firsts = np.cumsum([0, *[len(p) + self.least for p in parts]])
        known = ids != 0
        whole = known[: len(ids) - self.least + 1].copy()
        for k in range(1, self.least):
            whole &= known[k : len(ids) - self.least + 1 + k]
        at = np.flatnonzero(whole)
        seeds = np.zeros(len(at), np.uint64)
        for k in range(self.least):
            seeds = (seeds ^ ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            seeds ^= seeds >> np.uint64(29)
        slot = np.minimum(np.searchsorted(self.seeds, seeds), len(self.seeds) - 1)
        hit = self.seeds[slot] == seeds
        at, slot = at[hit], slot[hit]
        if not len(at):
            return found
        text = np.searchsorted(firsts, at, side="right") - 1
        # each text meets each seed once, then all the seed's places
        once = np.unique(np.stack([text, slot], axis=1), axis=0)
        counts = self.starts[once[:, 1] + 1] - self.starts[once[:, 1]]
        spread = np.repeat(np.arange(len(once)), counts)
        row = self.starts[once[spread, 1]] + np.arange(len(spread)) - np.repeat(np.cumsum(counts) - counts, counts)
        pair = once[spread, 0] * len(self.items) + self.item[row]
        longest = int(self.sizes.max()) + 1
        covered = np.unique(np.concatenate([pair * longest + self.place[row] + k for k in range(self.least)])) // longest
        pairs, bound = np.unique(covered, return_counts=True)
        for key in pairs[bound >= coverage * self.sizes[pairs % len(self.items)]].tolist():
            t, i = divmod(key, len(self.items))
            mine = np.isin(slot[text == t], np.unique(slot[text == t][np.isin(slot[text == t], self._slots(i))]))
            places = at[text == t][mine]
            held = np.unique((places[:, None] + np.arange(self.least)).ravel())
            # runs of the text that seeds of this item cover, with a token between that matches nothing
            cuts = np.flatnonzero(np.diff(held) > 1) + 1
            runs = [x for r in np.split(ids[held], cuts) for x in (*r.tolist(), -1)]
            got = tiles(self.items[i], runs, self.least)
            if got and (n := sum(k for *_, k in got)) >= coverage * len(self.items[i]):
                found[t].append((i, n, len(got), max(k for *_, k in got)))
        return found

    def _slots(self, item: int) -> np.ndarray:
        return np.searchsorted(self.seeds, self._seeds(np.array(self.items[item], dtype=np.int64)))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = BLOCK) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``size`` characters at most, one at a time; the table's size is measured first."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).filter(F.length("t") > 0)
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = -(-total // size)
    for k in range(parts):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k) if parts > 1 else items
        yield [(r["i"], r["t"]) for r in part.orderBy("i", "t").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE, size: int = BLOCK) -> DataFrame:
    """A row for each pair of a document and an item it leaks: the ids, the item's tokens, those covered, their share, tiles, the longest."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {picked.schema[0].dataType.simpleString()}, item_id {item_type}, n_tokens long, n_covered long, coverage double, n_tiles long, longest long"
    out = None
    for block in blocks(benchmark, size=size):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, index: Index) -> list:
            rows = [(i, *leak) for i, leaks in zip(batch.column(0).to_pylist(), index.leaks(batch.column(1).to_pylist(), coverage), strict=True) for leak in leaks]
            return [list(c) for c in zip(*[(d, index.ids[i], len(index.items[i]), n, n / len(index.items[i]), k, most) for d, i, n, k, most in rows], strict=True)] or [[]] * 7

        part = map_batches(picked, run, schema, text=1, setup=lambda held=held: Index(held.value))
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", coverage: float = COVERAGE, size: int = BLOCK) -> DataFrame:
    """``docs`` without the rows that leak any item; all columns stay."""
    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for block in blocks(benchmark, size=size):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, index: Index) -> list:
            clean = [not leaks for leaks in index.leaks(batch.column(at).to_pylist(), coverage)]
            return list(batch.filter(pa.array(clean, type=pa.bool_())).columns)

        docs = map_batches(docs, run, schema, text=at, setup=lambda held=held: Index(held.value))
    return docs
