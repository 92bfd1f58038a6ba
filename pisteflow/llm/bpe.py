"""Byte-level BPE encoding and decoding (operator 1).

Two tiers resolve a pre-token. A minimal perfect hash over the vocabulary answers whole
pre-tokens in one probe. Anything else is merged from single bytes: the bytes form a doubly
linked list and a heap yields the adjacent pair of lowest rank (leftmost on ties).

Defined results: null text is the empty text and has no ids; very long texts and very long
pre-tokens are encoded whole (the heap keeps a pre-token of n bytes at n log n); repeated rows
are encoded alike; an empty table gives an empty table; extra columns pass through, and input
columns named like an output column are replaced.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries of a worker's pre-token memo, in two generations; the older one is dropped when the
#: younger is full, so memory stays bounded.
MEMO_ENTRIES = 300_000
#: Texts whose characters all lie below this code point take the class-table pattern.
FAST_BELOW = 0x250

_OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType(), False),
    "ids_text": T.StringType(),
    "decoded": T.BinaryType(),
}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file of one base64 token and rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class MinimalPerfectHash:
    """Hash-and-displace table: n keys in exactly n slots, each checked by its own bytes.

    Keys are dealt to buckets by the low half of their 64-bit hash. Buckets are placed largest
    first; each gets the first displacement which sends all its keys to free slots.
    """

    def __init__(self, items: dict[bytes, int], per_bucket: int = 2):
        self.n = len(items)
        self.n_buckets = max(1, self.n // per_bucket)
        self.keys: list[bytes | None] = [None] * self.n
        self.values = np.zeros(self.n, dtype=np.int64)
        displacement = np.zeros(self.n_buckets, dtype=np.int64)
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(self.n_buckets)]
        for key in items:
            h = xxhash.xxh3_64_intdigest(key)
            buckets[(h & 0xFFFFFFFF) % self.n_buckets].append((h >> 32, key))
        singles = []
        free = np.ones(self.n, dtype=bool)
        for b in sorted(range(self.n_buckets), key=lambda b: -len(buckets[b])):
            bucket = buckets[b]
            if len(bucket) == 1:
                singles.append(b)
                continue
            d = 0
            while bucket:
                slots = {self._slot(h, d) for h, _ in bucket}
                if len(slots) == len(bucket) and all(free[s] for s in slots):
                    break
                d += 1
            for h, key in bucket:
                self._put(self._slot(h, d), key, items[key], free)
            displacement[b] = d
        # A bucket of one key stores its slot itself, as a negative number.
        for b, slot in zip(singles, np.flatnonzero(free), strict=False):
            self._put(int(slot), buckets[b][0][1], items[buckets[b][0][1]], free)
            displacement[b] = -int(slot) - 1
        self.displacement = displacement.tolist()
        self.values = self.values.tolist()

    def _slot(self, high: int, d: int) -> int:
        return ((high ^ (d * 0x9E3779B1)) * 0xFF51AFD7ED558CCD >> 20 & 0xFFFFFFFF) % self.n

    def _put(self, slot: int, key: bytes, value: int, free: np.ndarray) -> None:
        self.keys[slot], self.values[slot], free[slot] = key, value, False

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[(h & 0xFFFFFFFF) % self.n_buckets]
        slot = -d - 1 if d < 0 else self._slot(h >> 32, d)
        return self.values[slot] if self.keys[slot] == key else None


def byte_pairs(ranks: dict[bytes, int]) -> list[int | None]:
    """For two adjacent bytes (first * 256 + second), the rank of the pair as the high bits of an entry."""
    table: list[int | None] = [None] * 65536
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank << 64
    return table


def merge_bytes(piece: bytes, ranks: dict[bytes, int], pairs: list[int | None]) -> list[int]:
    """Ids of one pre-token: merge the adjacent pair of lowest rank until none has a rank.

    A heap entry is rank, start and stop of a pair in one integer, ordered like that triple.
    """
    n = len(piece)
    rank_of = ranks.get
    end = list(range(1, n + 2))  # of the part that begins here; 0 once it was merged away
    end[n] = 0
    prev = list(range(-1, n))
    heap, i, a = [], 0, piece[0]
    for b in piece[1:]:
        entry = pairs[a << 8 | b]
        if entry is not None:
            heap.append(entry | i << 32 | i + 2)
        a = b
        i += 1
    heapify(heap)
    while heap:
        entry = heappop(heap)
        stop, i = entry & 0xFFFFFFFF, entry >> 32 & 0xFFFFFFFF
        mid = end[i]
        if mid and end[mid] == stop:  # neither part has changed since
            end[i] = stop
            end[mid] = 0
            if stop < n:
                prev[stop] = i
                far = end[stop]
                rank = rank_of(piece[i:far])
                if rank is not None:
                    heappush(heap, rank << 64 | i << 32 | far)
            before = prev[i]
            if before >= 0:
                rank = rank_of(piece[before:stop])
                if rank is not None:
                    heappush(heap, rank << 64 | before << 32 | stop)
    ids, i = [], 0
    while i < n:
        stop = end[i]
        ids.append(ranks[piece[i:stop]])
        i = stop
    return ids


def _class(kinds: str) -> str:
    """Code points below FAST_BELOW of these general categories, as ranges of a class."""
    out, start = [], None
    for c in range(FAST_BELOW + 1):
        inside = c < FAST_BELOW and unicodedata.category(chr(c))[0] in kinds
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return "".join(out)


def _fast_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for re, with the properties spelt out for low code points."""
    space = r"\t-\r \u0085 "
    if r"(?!\S)" in pattern:
        letters, numbers = _class("L"), _class("N")
        spelt = (
            pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
            .replace(r"(?!\S)", f"(?![^{space}])")
            .replace(r"\p{L}", f"[{letters}]")
            .replace(r"\p{N}", f"[{numbers}]")
            .replace(r"\s", f"[{space}]")
        )
        if r"\p" not in spelt:
            return re.compile(spelt)
    return None


class _Memo(dict):
    """Pre-token to its ids as text; a missing one is resolved by the two tiers."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, str] = {}

    def __missing__(self, piece: str) -> str:
        text = self.older.get(piece)
        if text is None:
            text = " ".join(map(str, self.codec.encode_piece(piece.encode())))
        if len(piece) <= 64:
            if len(self) >= MEMO_ENTRIES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = text
        return text


class Codec:
    """Encoder and decoder of one rank table; picklable, built once on the driver."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.whole = MinimalPerfectHash(ranks)
        self._ready = False

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("ranks", "pattern", "whole")} | {"_ready": False}

    def _prepare(self) -> None:
        self.slow, self.fast = regex.compile(self.pattern), _fast_pattern(self.pattern)
        self.low = re.compile(f"[^\\u0000-\\u{FAST_BELOW - 1:04x}]")
        self.pairs = byte_pairs(self.ranks)
        self.memo = _Memo(self)
        self.bytes_of = {str(r): t for t, r in self.ranks.items()}
        self._ready = True

    def encode_piece(self, piece: bytes) -> list[int]:
        if not self._ready:
            self._prepare()
        whole = self.whole.get(piece)
        return [whole] if whole is not None else merge_bytes(piece, self.ranks, self.pairs)

    def pieces(self, text: str) -> list[str]:
        if self.fast and (text.isascii() or not self.low.search(text)):
            return self.fast.findall(text)
        return self.slow.findall(text)

    def encode_text(self, text: str | None) -> str:
        """Ids in decimal, joined by one space."""
        if not self._ready:
            self._prepare()
        memo = self.memo
        return " ".join([memo[p] for p in self.pieces(text)]) if text else ""

    def decode_text(self, ids_text: str) -> bytes:
        if not self._ready:
            self._prepare()
        return b"".join(map(self.bytes_of.__getitem__, ids_text.split(" "))) if ids_text else b""


def _as_lists(texts: list[str]) -> pa.ListArray:
    """Decimal ids of each text as one list<int> column."""
    ids = [np.fromstring(t, dtype=np.int32, sep=" ") if t else np.zeros(0, np.int32) for t in texts]
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(i) for i in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def encode_decode(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text_col: str = "text",
    outputs: tuple[str, ...] = ("ids",),
    keep: list[str] | None = None,
) -> DataFrame:
    """Encode a text column, and decode the ids again, in one pass without a shuffle.

    outputs: any of ``ids`` (array<int>), ``ids_text`` (decimal ids joined by one space) and
    ``decoded`` (the bytes that the ids stand for). keep: input columns to carry (all by
    default). The rank table is broadcast; its size is that of the vocabulary file.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in outputs]
    codec = df.sparkSession.sparkContext.broadcast(Codec(ranks, pattern))
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(o, _OUTPUTS[o]) for o in outputs)])
    at = "__bpe_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                texts = [own.encode_text(t) for t in batch.column(at).to_pylist()]
                made = {"ids_text": lambda: pa.array(texts, pa.string()), "decoded": lambda: pa.array([own.decode_text(t) for t in texts], pa.binary()), "ids": lambda: _as_lists(texts)}  # noqa: B023
                columns = [batch.column(k) for k in range(len(keep))] + [made[o]() for o in outputs]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *outputs])

    return df.select(*(F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(keep)), df[text_col].alias(at)).mapInArrow(run, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Bytes of an array<int> column of ids; null ids give null bytes, unknown ids raise."""
    table = df.sparkSession.sparkContext.broadcast({r: t for t, r in ranks.items()})
    keep = [c for c in df.columns if c != out_col]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = table.value.__getitem__
        for batch in batches:
            out = [None if ids is None else b"".join(map(of, ids)) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(out, pa.binary())], names=[*keep, out_col])

    return df.select(*keep).mapInArrow(run, schema)
