"""Token ids in training order: a keyed permutation gives every sequence its slot.

Each document's token ids, closed by an end mark, are cut into sequences of LENGTH
tokens, the last being filled up with end marks. A sequence's number counts through the
table in the order of its partitions and rows; a Feistel permutation of the next power
of four, walked in cycles until it falls below the number of sequences, turns it into a
slot. Sequences are sent to the partition of their slot's range, sorted, and written to
shards of SLOTS sequences of one stride, so slot ``s`` is at a place known beforehand
and reading can go on anywhere.

Tokens are counted in a first pass that keeps only a number per partition, and made
again in the second, so no copy of them is stored between. The two passes must see the
same rows in the same partitions: give a table or a checkpoint, and the second pass
fails if a partition's number is not what it was. A shard is written aside and renamed
when whole, so repeated or lost tasks leave whole files only.

Null and empty texts make one sequence of one end mark. Ids may be null or repeated.
Texts of any length are taken whole, and long runs of white space are encoded apart, as
the library's pattern overflows on them; texts without two white spaces in a row are cut by
the pattern without its look-ahead, which gives the same ids sooner; other columns are left
alone; an empty table makes no shard.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.functions.text import _WHITE, LONG_SPACE, encoder_parts
from blockspark.llm.common import slices
from blockspark.session import ship

#: Vocabulary file of ranks; tokens in a sequence; sequences in a shard; the permutation's key and rounds.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH, SLOTS, KEY, ROUNDS = 512, 16_384, 0x5EED, 8
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What the look-ahead is for is a run of two white spaces or more; without it the pattern needs no backtracking.
LOOK_AHEAD, RUN = r"|\s+(?!\S)", f"[{_WHITE}]{{2}}"


class Encoder:
    """Texts to ids as bytes. (A cache of words was measured and is slower than the library.)"""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        #: the first id that is no token's
        self.end = max(ranks.values()) + 1
        # ids as a buffer come with a search for end marks; none is allowed in a text, so one written there is text
        marks = {"<|endoftext|>": self.end}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=marks)
        self.plain = tiktoken.Encoding("plain", pat_str=PATTERN.replace(LOOK_AHEAD, ""), mergeable_ranks=ranks, special_tokens=marks)
        self.type = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.end_bytes = np.array([self.end], self.type).tobytes()

    def tokens(self, text: str, runs: bool = True) -> np.ndarray:
        """Ids of a text; ``runs`` is false only where no two white spaces follow each other."""
        if not runs:
            return self.plain.encode_to_numpy(text, disallowed_special=())
        if len(text) < LONG_SPACE:
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.concatenate([np.array(self.encoding._encode_single_piece(part), np.uint32) if one else self.encoding.encode_to_numpy(part, disallowed_special=()) for one, part in encoder_parts(text, False)])

    def ids(self, text: str) -> list[int]:
        return self.tokens(text).tolist()

    def count(self, text: str | None, runs: bool = True) -> int:
        """Ids of a text, the end mark included."""
        return 1 + (len(self.tokens(text, runs)) if text else 0)

    def encode(self, text: str | None, runs: bool = True) -> bytes:
        """All ids of a text and the end mark."""
        return self.tokens(text, runs).astype(self.type).tobytes() + self.end_bytes if text else self.end_bytes


def texts(column: pa.Array) -> Iterator[tuple[str | None, bool]]:
    """Each text, and whether it has two white spaces in a row."""
    return zip(column.to_pylist(), pc.match_substring_regex(column, RUN).to_pylist(), strict=True)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A round's function: 64 bits, all depending on each bit given."""
    x = x + np.uint64((key * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, size: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The slot below ``size`` of each number below ``size``; with ``back`` the number of each slot."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            if back:
                left, right = right ^ (_mix(left, key * ROUNDS + r) & mask), left
            else:
                left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def counts(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> dict[int, int]:
    """Sequences in each partition: one number a partition reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = encoder(vocabulary), 0
        for batch in batches:
            for part in slices(batch, 1):
                total += sum(-(-held.count(*t) // length) for t in texts(part.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array([_partition()], pa.int32()), pa.array([total], pa.int64())], names=["k", "n"])

    ship(docs.sparkSession)
    return {r["k"]: r["n"] for r in docs.mapInArrow(run, "k int, n long").collect()}


def sequences(docs: DataFrame, number: dict[int, int], length: int = LENGTH, vocabulary: str = VOCABULARY, key: int = KEY) -> DataFrame:
    """(slot, doc_id, part, n_tokens, ids): every sequence with its slot."""
    size = sum(number.values())
    starts = dict(zip(sorted(number), np.cumsum([0, *[number[k] for k in sorted(number)]])[:-1].tolist(), strict=True))
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, me = encoder(vocabulary), _partition()
        wide = held.type.itemsize
        at = first = starts.get(me, 0)
        for batch in batches:
            for part in slices(batch, 1):
                rows, nth, used, ids = [], [], [], []
                for i, text in enumerate(texts(part.column(1))):
                    every = held.encode(*text)
                    for k, a in enumerate(range(0, len(every), wide * length)):
                        piece = every[a : a + wide * length]
                        rows.append(i)
                        nth.append(k)
                        used.append(len(piece) // wide)
                        ids.append(piece if len(piece) == wide * length else piece + held.end_bytes * (length - len(piece) // wide))
                slots = permute(np.arange(at, at + len(ids)), size, key)
                at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(slots), part.column(0).take(pa.array(rows, pa.int64())), pa.array(nth, pa.int32()), pa.array(used, pa.int32()), pa.array(ids, pa.binary())], names=["slot", "doc_id", "part", "n_tokens", "ids"])
        if at - first != number.get(me, 0):
            raise RuntimeError(f"partition {me} has {at - first} sequences where {number.get(me, 0)} were counted; give a table or a checkpoint")

    ship(docs.sparkSession)
    return docs.mapInArrow(run, f"slot long, doc_id {kind}, part int, n_tokens int, ids binary")


def shard_name(shard: int) -> str:
    return f"tokens-{shard:08d}.bin"


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, slots: int = SLOTS, vocabulary: str = VOCABULARY, key: int = KEY) -> DataFrame:
    """Write the shards as the result is computed; a row per sequence says where it is.

    slot, doc_id, part (of the document), n_tokens (without filling), shard, offset in
    bytes, crc32 of the sequence. Computing it again writes the same files again.
    """
    from pyarrow import fs

    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    number = counts(picked, length, vocabulary)
    size = sum(number.values())
    shards = -(-size // slots)
    partitions = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    each = max(1, -(-shards // partitions))
    stride = length * (2 if encoder(vocabulary).end < 1 << 16 else 4)
    place, root = fs.FileSystem.from_uri(folder)
    place.create_dir(root, recursive=True)
    kind = picked.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        shard, out, aside, due = -1, None, "", 0

        def close() -> None:
            if out is not None:
                if due != min(slots, size - shard * slots):
                    raise RuntimeError(f"shard {shard} has {due} sequences")
                out.close()
                where.move(aside, f"{path}/{shard_name(shard)}")

        for batch in batches:
            slot = batch.column(0).to_numpy()
            crc = []
            for s, ids in zip(slot.tolist(), batch.column(4).to_pylist(), strict=True):
                if s // slots != shard:
                    close()
                    shard, due, aside = s // slots, 0, f"{path}/.{uuid.uuid4().hex}"
                    out = where.open_output_stream(aside)
                if s - shard * slots != due:
                    raise RuntimeError(f"slot {s} came where {shard * slots + due} was due")
                out.write(ids)
                due += 1
                crc.append(zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(slot // slots, pa.int64()), pa.array(slot % slots * stride, pa.int64()), pa.array(crc, pa.int64())], names=["slot", "doc_id", "part", "n_tokens", "shard", "offset", "crc32"])
        close()

    rows = sequences(picked, number, length, vocabulary, key)
    ranged = rows.repartitionById(partitions, F.expr(f"cast(slot div {each * slots} as int)")).sortWithinPartitions("slot")
    return ranged.mapInArrow(run, f"slot long, doc_id {kind}, part int, n_tokens int, shard long, offset long, crc32 long")


def read_slots(folder: str, first: int, n: int, length: int = LENGTH, slots: int = SLOTS, type: str = "<u2") -> np.ndarray:
    """The ids of ``n`` consecutive slots from ``first`` on, a row each; fewer at the end."""
    from pyarrow import fs

    place, root = fs.FileSystem.from_uri(folder)
    stride = np.dtype(type).itemsize * length
    parts = []
    while n > 0:
        shard, row = divmod(first, slots)
        info = place.get_file_info(f"{root}/{shard_name(shard)}")
        if info.type == fs.FileType.NotFound or row * stride >= info.size:
            break
        take = min(n, info.size // stride - row)
        with place.open_input_file(f"{root}/{shard_name(shard)}") as file:
            file.seek(row * stride)
            parts.append(np.frombuffer(file.read(take * stride), type).reshape(take, length))
        first, n = first + take, n - take
    return np.concatenate(parts) if parts else np.zeros((0, length), type)
