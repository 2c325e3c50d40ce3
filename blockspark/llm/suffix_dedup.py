"""Suffix-array dedup: deep-shallow sorting of anchored suffixes, split among tasks.

A byte goes if a string of LENGTH bytes that covers it starts earlier too. Sorting every
suffix of a corpus would move each byte LENGTH times, so the suffix array is a sparse
one: in every window of LENGTH bytes the GRAM-byte string with the smallest hash is its
anchor, and equal windows have equal anchors at equal places. The windows that share an
anchor are one run, so there is about one anchor for (LENGTH - GRAM) / 2 bytes, and two
windows are equal exactly if their anchors agree far enough to the right and left.

1. Anchors go by their gram's hash to tasks, with a hash of all the bytes their windows
   cover. Runs that repeat within a task's input are decided before they are sent, so a
   passage in a third of all documents is sent once per task, not once per document.
   The tasks are as many as the corpus's bytes ask for.
2. There a run equal to an earlier one is a repeat as a whole. Only the first of each
   distinct run is left, and only those with an anchor in common with another need
   their bytes compared.
3. Those bytes are fetched and sorted, from the anchor rightwards and leftwards, by
   deep-shallow sorting: groups refined by a lexsort of eight-byte words to a shallow
   depth, then blind tries for the groups that still agree. A window equals an earlier one if both
   stand in one class of both orders.

Null texts count as empty; texts shorter than LENGTH lose nothing; texts of any length
are taken whole, in segments. Rows with the same id and text get the same result, and
neither is earlier than the other. A null id comes after all others. Other columns are
left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches, slices
from blockspark.session import ship

#: Bytes of a repeated string, and of an anchor (a multiple of eight).
LENGTH, GRAM = 100, 32
#: Bytes that the word-wise refinement compares before blind tries take over: rightwards beyond the gram, and leftwards.
SHALLOW = 16
#: Bytes of text whose anchors, some 38 bytes in every 34, one task of the second stage is meant to hold.
HELD = 1 << 27
#: Window starts in a segment, and anchors that a task gathers before it sends them.
SEGMENT, GATHERED = 1 << 20, 1 << 20
LAST = (1 << 63) - 1
ENTRY = np.dtype([("a", "<u4"), ("left", "u1"), ("right", "u1"), ("whole", "u1")])
_U = np.uint64
_MIX, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)
_LETTER = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(1, np.uint64)
    top = base
    while len(out) < n:
        out = np.concatenate([out, out * _U(top)])
        top = top * top & (1 << 64) - 1
    return out[:n]


class Anchors:
    """Anchors of texts: the hash arrays' fixed parts are made once."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        assert gram % 8 == 0 < gram < length <= 255
        self.length, self.gram = length, gram
        self.up = _powers(_STEP, SEGMENT + 8 * length)
        self.down = _powers(pow(_STEP, -1, 1 << 64), SEGMENT + 8 * length)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, anchor, left, right, gram's hash, windows' hash) of each run of windows.

        The run's windows start from ``left`` to ``right`` bytes before the anchor.
        """
        parts = []
        pending: list[tuple[int, int, bytes]] = []
        held = 0
        for k, t in enumerate(texts):
            for start in range(0, max(1, len(t) - self.length + 1), SEGMENT):
                piece = t if len(t) <= SEGMENT else t[start : start + SEGMENT + self.length - 1]
                if len(piece) < self.length:
                    continue
                if held + len(piece) > SEGMENT + self.length and pending:
                    parts.append(self._segment(pending))
                    pending, held = [], 0
                pending.append((k, start, piece))
                held += len(piece)
        if pending:
            parts.append(self._segment(pending))
        if not parts:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _segment(self, pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        raw = b"".join(p for *_, p in pieces)
        n, size = len(raw) - self.gram + 1, self.length - self.gram + 1
        words = np.ndarray(len(raw) - 7, "<u8", buffer=raw, strides=(1,))
        h = words[:n] * _MIX
        h ^= h >> _U(32)
        for o in range(8, self.gram, 8):
            h = (h + words[o : o + n]) * _MIX2
            h ^= h >> _U(29)
        low = (h >> _U(32) << _U(32)) | np.arange(n, dtype=np.uint64)
        span = 1
        while span * 2 <= size:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if size > span:
            low = np.minimum(low[: len(low) - (size - span)], low[size - span :])
        anchor = (low & _U(0xFFFFFFFF)).astype(np.int64)
        starts = np.cumsum([0, *[len(p) for *_, p in pieces]])
        inside = np.zeros(len(anchor) + 1, bool)
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            inside[s : e - self.length + 1] = True
        inside = inside[:-1]
        opens = inside.copy()
        opens[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        first = np.flatnonzero(opens)
        closes = inside.copy()
        closes[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
        last = np.flatnonzero(closes)
        at = anchor[first]
        left, right = at - first, at - last
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTER[np.frombuffer(raw, np.uint8)] * self.up[: len(raw)], out=sums[1:])
        c = (sums[last + self.length] - sums[first]) * self.down[first]
        c = (c ^ (c >> _U(31)) ^ (left.astype(np.uint64) << _U(8)) ^ right.astype(np.uint64)) * _MIX
        c ^= c >> _U(32)
        piece = np.searchsorted(starts, first, side="right") - 1
        which = np.array([k for k, *_ in pieces])[piece]
        base = np.array([s for _, s, _ in pieces])[piece] - starts[piece]
        return which, at + base, left, right, h[at], c


def _text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _by_text(doc: np.ndarray, key: np.ndarray, entry: np.ndarray) -> tuple[list, list, list]:
    """Entries packed per (doc, key)."""
    if not len(doc):
        return [], [], []
    order = np.lexsort((key, doc))
    doc, key, entry = doc[order], key[order], entry[order]
    cut = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    raw, width = entry.tobytes(), entry.dtype.itemsize
    ends = np.append(cut[1:], len(doc))
    return doc[cut].tolist(), key[cut].tolist(), [raw[a * width : b * width] for a, b in zip(cut.tolist(), ends.tolist(), strict=True)]


def _repeats(gram: np.ndarray, run: np.ndarray, doc: np.ndarray, key: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order, and in it: whether a run is the first of its like, starts later than that, or is it or ties with it.

    Unlike texts of one id may tie at the same place; each such text is there once.
    """
    order = np.lexsort((a, doc, run, gram))
    g, r, d, p = gram[order], run[order], doc[order], a[order]
    fresh = np.append(True, (g[1:] != g[:-1]) | (r[1:] != r[:-1]))
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = (d != d[head]) | (p != p[head])
    tied = ~fresh & ~later
    if tied.any():
        order = np.lexsort((key, a, doc, run, gram))
        k = key[order]
        tied[1:] &= k[1:] != k[:-1]
    return order, fresh, later, fresh | tied


_COLUMNS = (("gram", "<u8"), ("run", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("a", "<u4"), ("left", "u1"), ("right", "u1"))


def _pack(columns: list[np.ndarray]) -> bytes:
    return b"".join(c.astype(t).tobytes() for c, (_, t) in zip(columns, _COLUMNS, strict=True))


def _unpack(blobs: list[bytes]) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in _COLUMNS)
    out: list[list[np.ndarray]] = [[] for _ in _COLUMNS]
    for blob in blobs:
        n, at = len(blob) // width, 0
        for k, (_, t) in enumerate(_COLUMNS):
            out[k].append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(c) if c else np.zeros(0, t) for c, (_, t) in zip(out, _COLUMNS, strict=True)]


def _send(docs: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """(bucket, doc, key, blob): anchors packed by their gram's bucket; decided runs packed by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        held: list[tuple[np.ndarray, ...]] = []
        turn = 0

        def flush() -> pa.RecordBatch:
            nonlocal turn
            g, r, d, k, a, left, right = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order, _, later, first = _repeats(g, r, d, k, a)
            entry = np.zeros(int(later.sum()), ENTRY)
            gone = order[later]
            entry["a"], entry["left"], entry["right"], entry["whole"] = a[gone], left[gone], right[gone], 1
            docs_, keys, blobs = _by_text(d[gone], k[gone], entry)
            buckets = [(turn + i) % parts for i in range(len(blobs))]
            turn += len(blobs)
            keep = np.sort(order[first])  # in the order of the texts, whose columns then pack well
            bucket = (g[keep] % _U(parts)).astype(np.int64)
            place = np.argsort(bucket, kind="stable")
            keep, bucket = keep[place], bucket[place]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
            for s, e in zip(cut.tolist(), np.append(cut[1:], len(bucket)).tolist(), strict=True):
                i = keep[s:e]
                buckets.append(int(bucket[s]))
                docs_.append(None)
                keys.append(None)
                blobs.append(_pack([x[i] for x in (g, r, d, k, a, left, right)]))
            return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(docs_, pa.int64()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "doc", "key", "blob"])

        total = 0
        for batch in batches:
            for part in slices(batch, 1):
                texts = _bytes(part.column(1).to_pylist())
                which, a, left, right, g, r = finder.of(texts)
                if len(which):
                    doc = part.column(0).to_numpy(zero_copy_only=False)[which]
                    key = np.array([_text_key(t) if len(t) >= length else 0 for t in texts], dtype=np.int64)[which]
                    held.append((g, r, doc, key, a, left, right))
                    total += len(which)
                    if total >= GATHERED:
                        yield flush()
                        total = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "bucket int, doc long, key long, blob binary")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key, entries): runs that repeat an earlier one, and first runs whose gram another has too."""
    names = ["doc", "key", "entries"]
    blobs: list[bytes] = []
    for batch in batches:
        ready = batch.column(1).is_valid()
        passed = batch.filter(ready)
        if passed.num_rows:
            yield pa.RecordBatch.from_arrays([passed.column(1), passed.column(2), passed.column(3)], names=names)
        blobs += batch.filter(batch.column(1).is_null()).column(3).to_pylist()
    g, r, d, k, a, left, right = _unpack(blobs)
    blobs.clear()
    if not len(g):
        return
    order, fresh, later, first = _repeats(g, r, d, k, a)
    g = g[order]
    # how many distinct runs a gram has
    opens = np.append(True, g[1:] != g[:-1])
    which = np.cumsum(opens) - 1
    distinct = np.bincount(which, fresh)[which]
    first = first & (distinct > 1)
    pick = later | first
    i = order[pick]
    entry = np.zeros(len(i), ENTRY)
    entry["a"], entry["left"], entry["right"], entry["whole"] = a[i], left[i], right[i], later[pick]
    docs_, keys, packed = _by_text(d[i], k[i], entry)
    for s in range(0, len(packed), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[s : s + 20_000], t) for x, t in ((docs_, pa.int64()), (keys, pa.int64()), (packed, pa.binary()))], names=names)


def blind_trie(strings: list[bytes]) -> list[int]:
    """The order of strings of one length.

    A node knows the byte at which its strings part and no other; a string goes down by
    those bytes alone to some leaf, and one comparison with it shows where it belongs.
    """
    root: list | None = None  # a node is [depth, {byte: node}], a leaf [-1, indices]
    for i, s in enumerate(strings):
        if root is None:
            root = [-1, [i]]
            continue
        path, node = [], root
        while node[0] >= 0:
            path.append(node)
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        t = strings[node[1][0]]
        if s == t:
            node[1].append(i)
            continue
        differs = int.from_bytes(s, "big") ^ int.from_bytes(t, "big")
        depth = len(s) - (differs.bit_length() + 7) // 8
        above = None
        below = root
        for step in path:
            if step[0] >= depth:
                below = step
                break
            above, below = step, step[1].get(s[step[0]])
        if below is not None and below[0] == depth:
            below[1][s[depth]] = [-1, [i]]
            continue
        between = [depth, {t[depth]: below, s[depth]: [-1, [i]]}]
        if above is None:
            root = between
        else:
            above[1][s[above[0]]] = between
    order, todo = [], [root] if root else []
    while todo:
        node = todo.pop()
        if node[0] < 0:
            order += node[1]
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return order


def deep_shallow(rows: np.ndarray, shallow: int) -> np.ndarray:
    """The order of the rows of a byte matrix.

    A lexsort of words of eight bytes refines all groups of a depth at once, without
    three-way partitioning, until ``shallow`` bytes; groups that still agree are ordered by blind tries.
    """
    n, width = rows.shape
    order = np.arange(n)
    group = np.zeros(n, np.int64)
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    depth = 0
    while depth < min(shallow, width):
        alone = np.append(True, group[1:] != group[:-1]) & np.append(group[1:] != group[:-1], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            return order
        sub = order[open_]
        place = np.lexsort((words[sub, depth // 8], group[open_]))
        order[open_] = sub[place]
        w = words[order, depth // 8]
        group = np.cumsum(np.append(False, (group[1:] != group[:-1]) | (w[1:] != w[:-1])))
        depth += 8
    if depth < width and n:
        cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for s, e in zip(cut.tolist(), np.append(cut[1:], n).tolist(), strict=True):
            if e - s > 1:
                some = order[s:e]
                tails = rows[some, depth:]
                if (tails == tails[0]).all():
                    continue
                raw, size = tails.tobytes(), width - depth
                order[s:e] = some[blind_trie([raw[k : k + size] for k in range(0, len(raw), size)])]
    return order


def agreement(rows: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each row in order, the bytes it shares with the row before; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for s in range(1, len(order), 65_536):
        i, j = order[s - 1 : s + 65_535], order[s : s + 65_536]
        i = i[: len(j)]
        differ = rows[i] != rows[j]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[s : s + len(j)] = np.minimum(common, np.minimum(sizes[i], sizes[j]))
    return out


def repeated_windows(doc: np.ndarray, a: np.ndarray, left: np.ndarray, right: np.ndarray, contexts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, start before its anchor) of each window that equals an earlier one among these runs.

    contexts: the bytes all of a run's windows cover, from ``left`` before its anchor.
    """
    n = len(contexts)
    forward, backward = np.zeros((n, length), np.uint8), np.zeros((n, length - gram), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    flat = np.frombuffer(b"".join(contexts), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255; 0 is the end
    starts = np.cumsum(sizes) - sizes
    ahead = sizes - left
    for column in range(length):
        has = ahead > column
        forward[has, column] = flat[(starts + left)[has] + column]
    for column in range(length - gram):
        has = left > column
        backward[has, column] = flat[(starts + left)[has] - 1 - column]
    f_order, b_order = deep_shallow(forward, gram + SHALLOW), deep_shallow(backward, SHALLOW)
    f_same, b_same = agreement(forward, ahead, f_order), agreement(backward, left, b_order)
    by_start = np.lexsort((a, doc))
    runs, offsets = [], []
    f_class, b_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(int(right.min(initial=0)), int(left.max(initial=-1)) + 1):
        here = by_start[(right[by_start] <= o) & (o <= left[by_start])]
        if len(here) < 2:
            continue
        f_class[f_order] = np.cumsum(f_same < length - o)
        b_class[b_order] = np.cumsum(b_same < o)
        both = f_class[here] * (n + 1) + b_class[here]
        _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        head = here[first][inverse]
        again = here[(doc[here] != doc[head]) | (a[here] != a[head])]
        runs.append(again)
        offsets.append(np.full(len(again), o))
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(runs), np.concatenate(offsets)


def _fetch(joined: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """(bucket, doc, key, entries, contexts): the bytes of first runs, packed by text and their gram's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: tuple[list, ...] = ([], [], [], [], [])
                for doc, key, packed, lists in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    entry = np.frombuffer(b"".join(lists), ENTRY)
                    entry = entry[entry["whole"] == 0]
                    if not len(entry):
                        continue
                    text = zstandard.decompress(packed)
                    by: dict[int, tuple[list, list]] = {}
                    for k, (a, before, after) in enumerate(zip(entry["a"].tolist(), entry["left"].tolist(), entry["right"].tolist(), strict=True)):
                        bucket = int.from_bytes(hashlib.blake2b(text[a : a + gram], digest_size=7).digest(), "little") % parts
                        rows, contexts = by.setdefault(bucket, ([], []))
                        rows.append(k)
                        contexts.append(text[a - before : a - after + length])
                    for bucket, (rows, contexts) in by.items():
                        for column, value in zip(out, (bucket, doc, key, entry[rows].tobytes(), b"".join(contexts)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "doc", "key", "entries", "contexts"])

    return joined.mapInArrow(run, "bucket int, doc long, key long, entries binary, contexts binary")


RANGE = np.dtype([("start", "<u4"), ("stop", "<u4")])


def _sorted(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, entries, contexts = [], [], [], []
        for batch in batches:
            for doc, key, packed, raw in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                entry = np.frombuffer(packed, ENTRY)
                docs.append(np.full(len(entry), doc))
                keys.append(np.full(len(entry), key))
                entries.append(entry)
                at = 0
                for size in (entry["left"].astype(int) - entry["right"] + length).tolist():
                    contexts.append(raw[at : at + size])
                    at += size
        if not docs:
            return
        doc, key, entry = np.concatenate(docs), np.concatenate(keys), np.concatenate(entries)
        a, left, right = entry["a"].astype(np.int64), entry["left"].astype(np.int64), entry["right"].astype(np.int64)
        which, offset = repeated_windows(doc, a, left, right, contexts, length, gram)
        ranges = np.zeros(len(which), RANGE)
        ranges["start"] = a[which] - offset
        ranges["stop"] = ranges["start"] + 1
        order = np.lexsort((ranges["start"], which))
        which, ranges = which[order], ranges[order]
        # windows in a row become one range
        opens = np.append(True, (which[1:] != which[:-1]) | (ranges["start"][1:] != ranges["stop"][:-1])) if len(which) else np.zeros(0, bool)
        head = np.flatnonzero(opens)
        merged = ranges[head].copy()
        merged["stop"] = ranges["stop"][np.append(head[1:], len(ranges)) - 1] if len(head) else merged["stop"]
        columns = _by_text(doc[which[head]], key[which[head]], merged)
        for s in range(0, len(columns[0]), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[s : s + 20_000], t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc", "key", "ranges"])

    return run


def _spans(n: int, entries: list[bytes] | None, ranges: list[bytes] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a text of ``n`` bytes."""
    entry = np.frombuffer(b"".join(entries or []), ENTRY)
    entry = entry[entry["whole"] == 1]
    more = np.frombuffer(b"".join(ranges or []), RANGE)
    a = entry["a"].astype(np.int64)
    starts = np.concatenate([a - entry["left"], more["start"].astype(np.int64)])
    if not len(starts):
        return []
    stops = np.concatenate([a - entry["right"] + length, more["stop"].astype(np.int64) - 1 + length])
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    opens = np.flatnonzero(np.append(True, starts[1:] > stops[:-1]))
    return list(zip(starts[opens].tolist(), stops[np.append(opens[1:], len(starts)) - 1].tolist(), strict=True))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, parts: int | None = None) -> DataFrame:
    """A row per row: id, n_bytes, spans (start and end in bytes of what is removed), kept_sha256 of the rest."""
    spark = docs.sparkSession
    ship(spark)
    if not parts:  # by what the corpus holds, so that no task's share grows with it
        total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // HELD))
    picked = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    entries = _send(picked, parts, length, gram).repartitionById(parts, F.col("bucket")).mapInArrow(_decide, "doc long, key long, entries binary")
    entries = entries.groupBy("doc", "key").agg(F.collect_list("entries").alias("entries"))

    def pack(batch: pa.RecordBatch, small: zstandard.ZstdCompressor) -> list:
        texts = _bytes(batch.column(1).to_pylist())
        return [batch.column(0), [_text_key(t) for t in texts], [small.compress(t) for t in texts]]

    texts = map_batches(picked, pack, "doc long, key long, packed binary", text=1, setup=lambda: zstandard.ZstdCompressor(level=3))
    joined = texts.hint("merge").join(entries, ["doc", "key"], "left")
    fetched = _fetch(joined.filter(F.col("entries").isNotNull()).select("doc", "key", "packed", "entries"), parts, length, gram)
    ranges = fetched.repartitionById(parts, F.col("bucket")).mapInArrow(_sorted(length, gram), "doc long, key long, ranges binary").groupBy("doc", "key").agg(F.collect_list("ranges").alias("ranges"))

    def finish(batch: pa.RecordBatch) -> list:
        sizes, spans, hashes = [], [], []
        for packed, lists, more in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
            text = zstandard.decompress(packed)
            found = _spans(len(text), lists, more, length)
            kept, past = hashlib.sha256(), 0
            for start, end in found:
                kept.update(text[past:start])
                past = end
            kept.update(text[past:])
            sizes.append(len(text))
            spans.append([{"start": s, "end": e} for s, e in found])
            hashes.append(kept.hexdigest())
        return [batch.column(0), sizes, spans, hashes]

    both = joined.join(ranges, ["doc", "key"], "left").select(F.when(F.col("doc") != LAST, F.col("doc")).alias(id_col), "packed", "entries", "ranges")
    return map_batches(both, finish, f"`{id_col}` long, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string")


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
