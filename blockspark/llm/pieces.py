"""SentencePiece encoding and decoding: the N best segmentations of a text.

The lattice holds every vocabulary piece at every place, weighed by the score that the
model file gives it; a character without a piece of its own is an unknown node at the
lowest score less UNKNOWN, spelled out in byte pieces. Forward Viterbi gives each place
its best score from the start. Searching backwards from the end, those scores are exact
heuristics, so A* takes segmentations off its agenda in their order.

No piece holds a space mark behind anything but space marks, so a text's lattice is a
chain of its words', a word being a run of marks and what follows it (with a vocabulary
that has such pieces, a text is one word). Words are solved once per worker, many at a
time in numpy; the forward pass also keeps how much the second-best way into each place
loses. The N best of a text differ from its best one in at most N - 1 words, namely those
that lose least, so only they are searched backwards, and their lists are merged by score.

Pieces of white space alone weigh what the model file says, too (a billion below zero in
this one, as they have no rank), so an unknown character weighs a little less than that.
Null texts count as empty and have no piece; texts are taken whole and come back byte
for byte, whatever white space or unknown characters they hold. Ids may be null or
repeated; other columns are left alone; an empty table gives an empty result. Equal
scores are ordered by the place of the change, then by the search's order.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from bisect import insort
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches

#: Model file; segmentations; how far an unknown character is below the lowest score; words, and characters of them, that a worker remembers; the longest word solved in numpy, and the longest remembered.
MODEL, BEST, UNKNOWN, REMEMBERED, CHARACTERS, WIDEST, LONGEST = "/opt/tokenizers/piece_bpe_32k.model", 4, 10.0, 400_000, 8_000_000, 24, 256
#: Scores are kept to this fraction, so their sums are exact and ties are ties in whatever order they are added.
GRAIN = 2.0**-16
SPACE = 0x2581
#: Words of a text that begins with a space, and places of a search whose ways are held.
WORDS, HELD = re.compile(" +[^ ]*"), 4096
#: A text's own U+2581 stands here as a code point that no piece has.
FOREIGN = 0x110000
_B = np.uint64(0x9E3779B97F4A7C15)
Path = tuple[float, tuple[int, ...]]


def _exact(score: float) -> float:
    return int(score) if score == int(score) else score


class Pieces:
    """A vocabulary, its lattice and the words solved so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[tuple[int, ...], tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece, score = model.id_to_piece(i), round(model.get_score(i) / GRAIN) * GRAIN
            self.spelled.append(b"")
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.spelled[i] = piece.replace("▁", " ").encode()
                self.scores[tuple(map(ord, piece))] = (i, score)
        self.unknown = min(s for _, s in self.scores.values()) - UNKNOWN
        #: the same by string, whole scores as integers, whose sums are exact in words of any length
        self.named = {"".join(map(chr, piece)): (i, _exact(s)) for piece, (i, s) in self.scores.items()}
        self.chained = not any("▁" in piece.lstrip("▁") for piece in self.named)
        self.longest = max(map(len, self.scores))
        prefixes: dict[int, tuple[int, float]] = {}
        for piece, (i, score) in self.scores.items():
            h = 0
            for k, c in enumerate(piece):
                h = (h + c + 1) * int(_B) & (1 << 64) - 1
                h ^= h >> 31
                if k == len(piece) - 1:
                    prefixes[h] = (i, score)
                else:
                    prefixes.setdefault(h, (-1, 0.0))
        self.keys = np.array(sorted(prefixes), dtype=np.uint64)
        self.piece = np.array([prefixes[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.score = np.array([prefixes[k][1] for k in self.keys.tolist()])
        #: word to (ids as bytes, score, loss of the second best)
        self.solved: dict[str, tuple[bytes, float, float]] = {}
        self.lists: dict[tuple[str, int], list[Path]] = {}
        self.characters = 0

    # one lattice, step by step

    def ways(self, points: list[int]) -> Callable[[int], list[tuple[int, int, float]]]:
        """Gives the ways into a place: (start, piece or -1 for unknown, score), earlier starts first."""
        # no piece has a plain space
        letters = "".join([" " if c == FOREIGN else chr(c) for c in points])
        known, longest, unknown = self.named.get, self.longest, _exact(self.unknown)

        def into(place: int) -> list[tuple[int, int, float]]:
            found = []
            for start in range(max(0, place - longest), place):
                if (held := known(letters[start:place])) is not None:
                    found.append((start, *held))
            if not found or found[-1][0] < place - 1:
                found.append((place - 1, -1, unknown))
            return found

        return into

    def forward(self, into: Callable[[int], list[tuple[int, int, float]]], places: int) -> list[float]:
        best: list[float] = [0]
        for place in range(1, places + 1):
            best.append(max([best[i] + s for i, _, s in into(place)]))
        return best

    def search(self, points: list[int], n: int) -> list[Path]:
        """The ``n`` best segmentations, best first, as (score, ids).

        Among equals the one nearest the text's start goes on, so a repetitive word, in
        which nearly all segmentations tie, costs as many steps as it has places.
        """
        into = lru_cache(HELD)(self.ways(points))
        best = self.forward(into, len(points))
        agenda: list[tuple[float, int, int, float, tuple]] = [(-best[-1], len(points), 0, 0, ())]
        pushed, found = 0, []
        while agenda and len(found) < n:
            _, place, _, behind, path = agenda.pop(0)
            if place == 0:
                ids: list[int] = []
                while path:
                    start, piece, path = path
                    ids += self.spell(points[start]) if piece < 0 else (piece,)
                found.append((behind, tuple(ids)))
                continue
            left = n - len(found)
            for start, piece, score in into(place):
                pushed += 1
                after = (-(best[start] + behind + score), start, pushed)
                # what is behind the first n never comes up, as each of these ends before it
                if len(agenda) < left or after < agenda[left - 1]:
                    insort(agenda, (*after, behind + score, (start, piece, path)))
                    del agenda[left:]
        return found

    def spell(self, point: int) -> list[int]:
        """Byte pieces of an unknown character; the space mark is a space."""
        letter = " " if point == SPACE else "▁" if point == FOREIGN else chr(point)
        return [self.bytes[b] for b in letter.encode("utf-8", "surrogatepass")]

    @staticmethod
    def points(word: str) -> list[int]:
        """The word's code points behind a space mark."""
        return [SPACE, *[FOREIGN if c == "▁" else SPACE if c == " " else ord(c) for c in word]]

    def words(self, text: str) -> list[str]:
        """The words of a text that isn't empty, each without its first space."""
        if not self.chained:
            return [text]
        if text[0] == " " or "  " in text:
            return [w[1:] for w in WORDS.findall(" " + text)]
        return text.split(" ")

    # many words at once

    def solve(self, words: list[str]) -> None:
        """Add words to ``solved``, but for very long ones."""
        words = [w for w in words if len(w) <= LONGEST]
        self.characters += sum(map(len, words))
        if len(self.solved) + len(words) > REMEMBERED or self.characters > CHARACTERS:
            self.solved.clear()
            self.lists.clear()
            self.characters = sum(map(len, words))
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(-(-len(w) // 4) if len(w) <= WIDEST else -1, []).append(w)
        for k, group in by_length.items():
            if k < 0:
                for w in group:
                    self.solved[w] = self.alone(w)
            else:
                self._together(group)

    def alone(self, word: str) -> tuple[bytes, float, float]:
        points = self.points(word)
        into = self.ways(points)
        best, came, by = [0], array("q", [0]), array("i", [0])
        losses = [np.inf]
        for place in range(1, len(points) + 1):
            ways = into(place)
            totals = [best[i] + s for i, _, s in ways]
            top = max(totals)
            k = totals.index(top)
            rest = totals[:k] + totals[k + 1 :]
            best.append(top)
            came.append(ways[k][0])
            by.append(ways[k][1])
            losses.append(top - max(rest) if rest else np.inf)
        ids: list[list[int]] = []
        place, loss = len(points), np.inf
        while place:
            start, piece = came[place], by[place]
            loss = min(loss, losses[place])
            ids.append(self.spell(points[start]) if piece < 0 else [piece])
            place = start
        return np.array([i for part in reversed(ids) for i in part], "<i4").tobytes(), best[-1], float(loss)

    def _together(self, words: list[str]) -> None:
        lengths = np.array([len(w) + 1 for w in words])
        n, width = len(words), int(lengths.max())
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.zeros((n, width), np.uint32)
        points[:, 0] = SPACE
        inside = np.arange(1, width)[None, :] < lengths[:, None]
        points[:, 1:][inside] = np.where(flat == SPACE, FOREIGN, np.where(flat == ord(" "), SPACE, flat))
        best = np.full((n, width + 1), -np.inf)
        second = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came, by = np.zeros((n, width + 1), np.int32), np.zeros((n, width + 1), np.int32)

        def enter(rows: np.ndarray, start: int, place: int, total: np.ndarray, piece: np.ndarray | int) -> None:
            old = best[rows, place]
            better = total > old
            second[rows, place] = np.where(better, old, np.maximum(second[rows, place], total))
            won = rows[better]
            best[won, place], came[won, place] = total[better], start
            by[won, place] = piece[better] if isinstance(piece, np.ndarray) else piece

        for i in range(width):
            rows = np.flatnonzero(lengths > i)
            h = np.zeros(len(rows), np.uint64)
            for j in range(i + 1, min(width, i + self.longest) + 1):
                fits = lengths[rows] >= j
                rows, h = rows[fits], h[fits]
                if not len(rows):
                    break
                h = (h + points[rows, j - 1].astype(np.uint64) + np.uint64(1)) * _B
                h ^= h >> np.uint64(31)
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                known = self.keys[at] == h
                piece = np.where(known, self.piece[at], -1)
                if j == i + 1 and (bare := rows[piece < 0]).size:
                    enter(bare, i, j, best[bare, i] + self.unknown, -1)
                hit = piece >= 0
                if hit.any():
                    enter(rows[hit], i, j, best[rows[hit], i] + self.score[at[hit]], piece[hit])
                rows, h = rows[known], h[known]
        place, steps, starts, loss = lengths.copy(), [], [], np.full(n, np.inf)
        every = np.arange(n)
        bad = np.zeros(n, bool)
        while (place > 0).any():
            go = place > 0
            piece = np.where(go, by[every, place], -2)
            with np.errstate(invalid="ignore"):
                loss = np.where(go, np.fmin(loss, best[every, place] - second[every, place]), loss)
            bad |= piece == -1
            steps.append(piece)
            place = np.where(go, came[every, place], 0)
            starts.append(place)
        ids, starts = np.array(steps[::-1], dtype="<i4").T.copy(), np.array(starts[::-1]).T
        counts = (ids >= 0).sum(axis=1).tolist()
        tops = best[every, lengths].tolist()
        for k, (w, c, top, lost, odd) in enumerate(zip(words, counts, tops, loss.tolist(), bad.tolist(), strict=True)):
            if not odd:
                self.solved[w] = (ids[k, len(steps) - c :].tobytes(), top, lost)
                continue
            path: list[int] = []
            for piece, start in zip(ids[k].tolist(), starts[k].tolist(), strict=True):
                if piece >= -1:
                    path += [piece] if piece >= 0 else self.spell(int(points[k, start]))
            self.solved[w] = (np.array(path, "<i4").tobytes(), top, lost)

    # texts

    def best_of_word(self, word: str, n: int, solved: tuple[bytes, float, float]) -> list[Path]:
        """The word's ``n`` best, that of ``solved`` first."""
        if (found := self.lists.get((word, n))) is None:
            first = tuple(np.frombuffer(solved[0], "<i4").tolist())
            found = [(solved[1], first), *[p for p in self.search(self.points(word), n) if p[1] != first][: n - 1]]
            if len(word) <= LONGEST:
                self.lists[word, n] = found
        return found

    def encode(self, text: str | None, n: int = 1) -> tuple[list[str], list[bytes], list[tuple[float, dict[int, tuple[int, ...]]]]]:
        """Words, the ids of each, and the ``n`` best: (score, ids of the words in which it differs from the best)."""
        if not text:
            return [], [], [(0.0, {})]
        words = self.words(text)
        held = list(map(self.solved.get, words))
        if None in held:
            self.solve(list({w for w, h in zip(words, held, strict=True) if h is None}))
            held = [self.solved.get(w) or self.alone(w) for w in words]
        total = sum([h[1] for h in held])
        hypotheses: list[tuple[float, dict[int, tuple[int, ...]]]] = [(float(total), {})]
        if n > 1:
            losses = [h[2] for h in held]
            near = heapq.nsmallest(n - 1, range(len(words)), key=lambda k: (losses[k], k))
            lists = []
            for k in near:
                lists.append(self.best_of_word(words[k], n, held[k]))
            agenda = [(0.0, (0,) * len(near))]
            seen = {agenda[0][1]}
            hypotheses = []
            while agenda and len(hypotheses) < n:
                lost, ranks = heapq.heappop(agenda)
                hypotheses.append((float(total - lost), {near[k]: lists[k][r][1] for k, r in enumerate(ranks) if r}))
                for k, r in enumerate(ranks):
                    after = (*ranks[:k], r + 1, *ranks[k + 1 :])
                    if r + 1 < len(lists[k]) and after not in seen:
                        seen.add(after)
                        heapq.heappush(agenda, (sum(lists[m][0][0] - lists[m][q][0] for m, q in enumerate(after)), after))
        return words, [h[0] for h in held], hypotheses

    def prepare(self, texts: list[str | None]) -> None:
        """Solve the new words of many texts together."""
        new = {w for t in texts if t for w in self.words(t)} - self.solved.keys()
        if new:
            self.solve(list(new))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<i4").tolist()))[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def joined(parts: list[bytes], changes: dict[int, tuple[int, ...]]) -> bytes:
    if not changes:
        return b"".join(parts)
    parts = list(parts)
    for k, ids in changes.items():
        parts[k] = np.array(ids, "<i4").tobytes()
    return b"".join(parts)


def encode(docs: DataFrame, n: int = BEST, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, segmentations): the ``n`` best of each text, each with its score and ids, best first."""

    def run(batch: pa.RecordBatch) -> list:
        held, texts = pieces(model), batch.column(1).to_pylist()
        held.prepare(texts)
        out = []
        for text in texts:
            _, parts, best = held.encode(text, n)
            out.append([{"score": s, "ids": np.frombuffer(joined(parts, c), "<i4")} for s, c in best])
        return [batch.column(0), out]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, segmentations array<struct<score:double,ids:array<int>>>", text=1)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of rows with ids; null ids give the empty text."""

    def run(batch: pa.RecordBatch) -> list:
        held = pieces(model)
        return [batch.column(0), [held.decode(np.array(ids or [], "<i4").tobytes()) for ids in batch.column(1).to_pylist()]]

    picked = encoded.select(F.col(id_col), F.col(ids_col).alias("__ids"))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, text string")


def encoded(docs: DataFrame, n: int = BEST, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, with_ids: bool = False) -> DataFrame:
    """A row per row: id, n_pieces, best_scores, a hash of the best ids and of all N, whether decoding each gives the text; the ids too if asked."""

    def run(batch: pa.RecordBatch) -> list:
        held, texts = pieces(model), batch.column(1).to_pylist()
        held.prepare(texts)
        counts, scores, hashes, alls, same, every = [], [], [], [], [], []
        for text in texts:
            _, parts, best = held.encode(text, n)
            ids = b"".join(parts)
            whole = hashlib.sha256(ids)
            hashes.append(whole.hexdigest())
            same.append(held.decode(ids) == (text or "") and all(_spelled_alike(held, parts, c) for _, c in best[1:]))
            for _, changes in best[1:]:
                for k in sorted(changes):
                    whole.update(k.to_bytes(8, "little") + np.array(changes[k], "<i4").tobytes())
            counts.append(len(ids) // 4)
            scores.append([s for s, _ in best])
            alls.append(whole.hexdigest())
            if with_ids:
                every.append(np.frombuffer(ids, "<i4"))
        return [batch.column(0), counts, scores, hashes, alls, same, *([every] if with_ids else [])]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    schema = f"`{id_col}` {picked.schema[0].dataType.simpleString()}, n_pieces long, best_scores array<double>, ids_sha256 string, nbest_sha256 string, round_trip boolean"
    return map_batches(picked, run, schema + (", ids array<int>" if with_ids else ""), text=1)


def _spelled_alike(held: Pieces, parts: list[bytes], changes: dict[int, tuple[int, ...]]) -> bool:
    spell = lambda ids: b"".join(map(held.spelled.__getitem__, ids))
    return all(spell(ids) == spell(np.frombuffer(parts[k], "<i4").tolist()) for k, ids in changes.items())
