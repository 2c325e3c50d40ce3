"""SimHash near-duplicates: pigeonhole blocks, a join on them, Hamming verification.

A fingerprint has a bit set where over half of the text's shingle hashes have it. The
64 bits are cut into six blocks; two fingerprints that differ in at most three bits
agree on at least three blocks, so a join on every choice of three blocks (about 32
bits each) finds all of them. A pair is kept only at the first choice it agrees on, so
nothing has to be made distinct afterwards. Equal fingerprints are one class before
the join, so copies are never paired with each other. Where more than HOT fingerprints
share a key, as in a large family of near copies, the rest of their bits is split the
same way: six interleaved blocks, a join on every choice of three of them, so that not
all of them are compared.

Null and empty texts, and those of white space only, have fingerprint zero and are
linked like any other. Texts are taken whole. A row without an id counts as a
neighbour but never names a component unless all its ids are null. Repeated ids count
as many rows. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches, salted
from blockspark.session import shared_dir

#: Bits that may differ, and the widths of the blocks.
DISTANCE, WIDTHS = 3, (11, 11, 11, 11, 10, 10)
#: Fingerprints of one key that are compared without a further split.
HOT = 128


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> bytes:
    """Eight bytes, the highest bit first."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return bytes(8)
    whole, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= size:
        return digest(whole, seed)
    n = len(words) - size + 1
    stops = np.cumsum([len(w) + 1 for w in words]).tolist()
    hashes = b"".join([digest(whole[a : b - 1], seed) for a, b in zip([0, *stops], stops[size - 1 :], strict=False)])
    ones = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """(id, fp): the fingerprint as a signed long; and ``key``, a long that is carried along, if one is given."""

    def run(batch: pa.RecordBatch) -> list:
        bits = b"".join(map(fingerprint, batch.column(1).to_pylist()))
        return [batch.column(0), pa.array(np.frombuffer(bits, ">u8").astype(np.uint64).view(np.int64)), *batch.columns[2:]]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"), *([] if key is None else [key.alias("key")]))
    return map_batches(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, fp long" + ("" if key is None else ", key long"), text=1)


def masks() -> list[int]:
    """For each choice of blocks the bits it compares, as a signed long."""
    starts = np.cumsum((0, *WIDTHS)).tolist()
    blocks = [((1 << w) - 1) << s for w, s in zip(WIDTHS, starts, strict=False)]
    found = [sum(c) for c in combinations(blocks, len(WIDTHS) - DISTANCE)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def finer_masks() -> list[int]:
    """The same for blocks of every sixth bit, which cut across the others."""
    blocks = [sum(1 << b for b in range(k, 64, len(WIDTHS))) for k in range(len(WIDTHS))]
    found = [sum(c) for c in combinations(blocks, len(WIDTHS) - DISTANCE)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _first(apart: Column, choices: list[int]) -> Column:
    """The first choice of blocks in which no bit differs."""
    first: Column = F.lit(len(choices))
    for i, m in reversed(list(enumerate(choices))):
        first = F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)).otherwise(first)
    return first


def links(classes: DataFrame, hot: int | None = None) -> DataFrame:
    """Pairs a < b of unlike fingerprints within the distance, with the size of each class.

    classes: (fp, n), each fingerprint once.
    """
    from pyspark.sql import Window

    hot = HOT if hot is None else hot
    choices, finer = masks(), finer_masks()
    keys = lambda some, i, v: F.array(*[F.struct(F.lit(k).cast("tinyint").alias(i), F.col("fp").bitwiseAND(F.lit(m)).alias(v)) for k, m in enumerate(some)])
    rows = classes.select("fp", "n", F.explode(keys(choices, "i", "v")).alias("k")).select("fp", "n", "k.i", "k.v")
    rows = rows.withColumn("many", F.count("*").over(Window.partitionBy("i", "v")) > hot)
    whole = F.array(F.struct(F.lit(-1).cast("tinyint").alias("j"), F.lit(0).cast("long").alias("w")))
    rows = rows.select("fp", "n", "i", "v", F.explode(F.when(F.col("many"), keys(finer, "j", "w")).otherwise(whole)).alias("k")).select("fp", "n", "i", "v", "k.j", "k.w")
    a, b = (rows.select(F.col("fp").alias(x), F.col("n").alias(f"n{x}"), "i", "v", "j", "w") for x in "ab")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    same = (a["i"] == b["i"]) & (a["v"] == b["v"]) & (a["j"] == b["j"]) & (a["w"] == b["w"])
    once = (_first(apart, choices) == a["i"]) & ((a["j"] < 0) | (_first(apart, finer) == a["j"]))
    return a.join(b, same & (F.col("a") < F.col("b")) & (F.bit_count(apart) <= DISTANCE) & once).select("a", "na", "b", "nb")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge: the smallest node it reaches.

    Alternates the two star contractions until the edges stay as they are; each round
    is checkpointed to the shared folder.
    """
    held = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    sign = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    last = sign(held)
    if not last[0]:
        return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted(both.filter("v > u"), least, ["u"], how="inner").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted(large, least, ["u"], how="inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        held = small.checkpoint()
        if (now := sign(held)) == last:
            return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, fp, n_near (other rows linked to it), component_id, class_rows."""
    shared_dir(docs.sparkSession)
    prints = fingerprints(docs, id_col, text_col).checkpoint()
    classes = prints.groupBy("fp").agg(F.count("*").alias("n"), F.min(id_col).alias("least")).checkpoint()
    found = links(classes.select("fp", "n")).checkpoint()
    near = found.select(F.col("a").alias("fp"), F.col("nb").alias("n")).unionByName(found.select(F.col("b").alias("fp"), F.col("na").alias("n"))).groupBy("fp").agg(F.sum("n").alias("near"))
    rooted = classes.join(near, "fp", "left").join(components(found).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = salted(rooted, ids, ["root"], how="inner").select("fp", "n", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"), "component_id")
    return salted(prints, facts, ["fp"], how="inner").select(id_col, "fp", "n_near", "component_id", F.col("n").alias("class_rows"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("n_near").cast("long").alias("n_near"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, and of the least hash of the text among rows of that id.

    A row is named by its id and its text's hash, so unlike texts of one id are told
    apart; of rows alike in both one stays. Rows without an id cannot be named and all stay.
    """
    from pyspark.sql import Window

    shared_dir(docs.sparkSession)
    key, nth = _fresh(docs, "__key"), _fresh(docs, "__nth")
    hashed = lambda c: F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("")))
    prints = fingerprints(docs, id_col, text_col, hashed(text_col)).checkpoint()
    row = F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.col("key")))
    classes = prints.groupBy("fp").agg(F.count("*").alias("n"), F.min(row).alias("least")).checkpoint()
    found = links(classes.select("fp", "n")).checkpoint()
    rooted = classes.join(components(found).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stay = rooted.groupBy("root").agg(F.min("least").alias("least")).filter("least IS NOT NULL").select(F.col("least.id").alias(id_col), F.col("least.key").alias(key)).distinct()
    named = docs.filter(F.col(id_col).isNotNull()).withColumn(key, hashed(text_col)).join(stay, [id_col, key], "left_semi")
    named = named.withColumn(nth, F.row_number().over(Window.partitionBy(id_col, key).orderBy(key))).filter(F.col(nth) == 1).select(docs.columns)
    return named.unionByName(docs.filter(F.col(id_col).isNull()))
