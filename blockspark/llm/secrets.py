"""Secret scans: keyword automaton, anchored patterns near its hits, embedded checksums.

One Aho-Corasick pass over the lower-cased text finds every keyword. Only at those
places an anchored pattern is tried on the original text. Runs of hexadecimal digits
have no keyword and get a scan of their own. Kinds that carry a checksum count only
if it holds.

Nulls and empty texts give no span. A null id is kept. Texts of any length are scanned
whole, repeated rows are scanned each on its own, and other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockspark.llm.common import map_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Base kinds in the order that breaks ties, then those with a checksum.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv", "age")
RANK = {kind: i for i, kind in enumerate(KINDS)}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = {c: i for i, c in enumerate("123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz")}
_BECH32 = {c: i for i, c in enumerate("qpzry9x8gf2tvdw0s3jn54khce6mua7l")}


def base62_crc32(body: str, tail: str) -> bool:
    """Whether ``tail`` is the CRC-32 of ``body`` in base 62, six digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = _BASE62[rest] + digits
    return digits == tail


def base58_check(text: str) -> bool:
    """Whether the last four bytes are those of the doubled SHA-256 of the rest."""
    value = 0
    for c in text:
        value = value * 58 + _BASE58[c]
    raw = value.to_bytes(82, "big") if value.bit_length() <= 656 else b""
    return len(raw) == 82 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_check(text: str) -> bool:
    """Whether a Bech32 string's six last letters close its polynomial."""
    prefix, _, data = text.lower().rpartition("1")
    check = 1
    for v in [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [_BECH32[c] for c in data]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= g if top >> i & 1 else 0
    return check == 1


CHECKED = {
    "github": (re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), lambda m: base62_crc32(m[1], m[2])),
    "npm": (re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), lambda m: base62_crc32(m[1], m[2])),
    "xprv": (re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])"), lambda m: base58_check(m[0])),
    "age": (re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Z0-9])"), lambda m: bech32_check(m[0])),
}
_WORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"), "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"), "npm_": "npm", "xprv": "xprv", "age-secret-key-1": "age",
}


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in _WORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and added spans as (start, end, kind), each in order."""
    if not text:
        return [], []
    base = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    added = []
    # only ASCII letters are folded, so that places stay the same
    hits = [(end + 1 - n, kind) for end, (n, kind) in automaton().iter(text if text.islower() and text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))]
    if hits:
        hits.sort()
        past = dict.fromkeys(KINDS, 0)
        for start, kind in hits:
            if start < past[kind]:
                continue
            if kind == "assign":
                if m := ASSIGN.match(text, start):
                    past[kind] = m.end()
                    if m.end(2) - m.start(2) >= 6:
                        base.append((start, m.end(), kind))
            elif kind == "access":
                if m := ACCESS.match(text, start):
                    past[kind] = m.end()
                    if m.end() - start >= 20:
                        base.append((start, m.end(), kind))
            else:
                pattern, holds = CHECKED[kind]
                if (m := pattern.match(text, start)) and holds(m):
                    past[kind] = m.end()
                    added.append((start, m.end(), kind))
    key = lambda s: (s[0], RANK[s[2]])
    return sorted(base, key=key), sorted(added, key=key)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, base spans and all spans with their kinds.

    Spans are code points, the end exclusive, in order of start and kind.
    """
    span = "array<struct<start:int,end:int,kind:string>>"

    def run(batch: pa.RecordBatch) -> list:
        base, every = [], []
        for text in batch.column(1).to_pylist():
            b, a = scan(text)
            base.append([{"start": s, "end": e, "kind": k} for s, e, k in b])
            every.append([{"start": s, "end": e, "kind": k} for s, e, k in sorted(b + a, key=lambda s: (s[0], RANK[s[2]]))] if a else base[-1])
        return [batch.column(0), base, every]

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = picked.schema[0].dataType.simpleString()
    return map_batches(picked, run, f"`{id_col}` {kind}, base {span}, spans {span}", text=1)


def digest(found: DataFrame) -> DataFrame:
    """The counts, hash and joined spans of ``find_secrets``."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in its text replaced by ``mark``; overlapping spans as one.

    All columns stay; ``n_chars``, where there is one, follows the new text. Null texts stay null.
    """

    def run(batch: pa.RecordBatch) -> list:
        at = batch.schema.get_field_index(text_col)
        texts = []
        for text in batch.column(at).to_pylist():
            base, added = scan(text)
            if base or added:
                parts, past = [], 0
                for start, end, _ in sorted(base + added):
                    if start >= past:
                        parts += [text[past:start], mark]
                    past = max(past, end)
                text = "".join([*parts, text[past:]])
            texts.append(text)
        return [pa.array(texts, type=pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]

    clean = map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), text=docs.columns.index(text_col))
    return clean.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean
