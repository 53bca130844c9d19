"""Byte-level BPE: encode texts to token ids and decode ids to bytes.

A text is split by the pattern of the tokenizer.  Each pre-token is resolved in
two tiers: a minimal perfect hash finds those that are tokens as they stand, and
the rest are merged by a heap over a linked list of their bytes, which takes
O(n log n) for a pre-token of n bytes however long it is.

Both operators are maps over rows: no shuffle, nothing is shared between tasks
but the vocabulary (about 50,000 entries, broadcast once).  A lost executor only
repeats its tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm.common import held, importable_in_tasks, map_batches, slices, text_of, tidy

# A task remembers this many resolved pre-tokens; then it starts over.
MEMO_ENTRIES = 300_000
# Pre-tokens longer than this are not remembered.
MEMO_BYTES = 64

_MASK = (1 << 64) - 1
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_TRIALS = 512


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Tokens and ids of a rank file: a base64 token and a number on each line."""
    with open(path, "rb") as file:
        fields = (line.split() for line in file if line.strip())
        return [(base64.b64decode(token), int(rank)) for token, rank in fields]


def _slots(hashes: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """Slot of every hash under every seed, one row for each hash."""
    mixed = hashes[:, None] + seeds[None, :] * np.uint64(_STEP)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_MIX)
    return ((mixed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash over a fixed set of keys, by hash and displace.

    Keys fall into small buckets.  From the largest bucket down, a seed is sought
    that sends all its keys to free slots; a bucket with one key simply names a
    free slot.  Slots are exactly as many as keys.  A key outside the set lands on
    the slot of another key, so the stored key is compared on every look-up.
    """

    def __init__(self, items: list[tuple[bytes, int]]):
        self.size = len(items)
        self.buckets = max(1, self.size // 3)
        hashes = np.array([xxhash.xxh64_intdigest(key) for key, _ in items], dtype=np.uint64)
        home = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        counts = np.bincount(home, minlength=self.buckets)
        starts = np.cumsum(counts) - counts
        taken = np.zeros(self.size, dtype=bool)
        seeds = np.zeros(self.buckets, dtype=np.int64)
        place = np.zeros(self.size, dtype=np.int64)
        for bucket in np.argsort(-counts, kind="stable"):
            count = int(counts[bucket])
            if count <= 1:
                break
            members = order[starts[bucket] : starts[bucket] + count]
            first = 1
            while True:
                trial = np.arange(first, first + _TRIALS, dtype=np.uint64)
                slots = _slots(hashes[members], trial, self.size)
                free = ~taken[slots].any(axis=0)
                for k in np.flatnonzero(free):
                    if len(set(slots[:, k].tolist())) == count:
                        break
                else:
                    first += _TRIALS
                    continue
                seeds[bucket] = int(trial[k])
                place[members] = slots[:, k]
                taken[slots[:, k]] = True
                break
        free_slots = iter(np.flatnonzero(~taken).tolist())
        for bucket in np.flatnonzero(counts == 1):
            slot = next(free_slots)
            seeds[bucket] = -slot - 1
            place[order[starts[bucket]]] = slot
        self.seeds = seeds.tolist()
        self.keys: list[bytes] = [b""] * self.size
        self.values = [0] * self.size
        for (key, value), slot in zip(items, place.tolist(), strict=True):
            self.keys[slot], self.values[slot] = key, value

    def find(self, key: bytes) -> int | None:
        """Value of the key, or None when it is not in the set."""
        if not self.size:
            return None
        digest = xxhash.xxh64_intdigest(key)
        seed = self.seeds[digest % self.buckets]
        if seed < 0:
            slot = -seed - 1
        else:
            mixed = (digest + seed * _STEP) & _MASK
            mixed = ((mixed ^ (mixed >> 29)) * _MIX) & _MASK
            slot = (mixed >> 32) % self.size
        return self.values[slot] if self.keys[slot] == key else None


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge neighbours, the lowest rank first and the leftmost of equal ones.

    The heap holds plain integers: rank, start, middle and stop of a possible
    merge, from the highest bits down.
    """
    size, find = len(piece), ranks.get
    bits = size.bit_length()
    mask, twice, thrice = (1 << bits) - 1, 2 * bits, 3 * bits
    end = list(range(1, size + 1))  # of the part that starts here
    before = list(range(-1, size))  # start of the part to the left
    heap = []
    for i in range(size - 1):
        rank = find(piece[i : i + 2])
        if rank is not None:
            heap.append(rank << thrice | i << twice | (i + 1) << bits | i + 2)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        left, middle, stop = entry >> twice & mask, entry >> bits & mask, entry & mask
        # An entry is stale when either part has been merged since.
        if end[left] != middle or end[middle] != stop:
            continue
        end[left], end[middle] = stop, -1
        before[stop] = left
        if stop < size:
            rank = find(piece[left : end[stop]])
            if rank is not None:
                heappush(heap, rank << thrice | left << twice | stop << bits | end[stop])
        first = before[left]
        if first >= 0:
            rank = find(piece[first:stop])
            if rank is not None:
                heappush(heap, rank << thrice | first << twice | left << bits | stop)
    ids, at = [], 0
    while at < size:
        stop = end[at]
        ids.append(ranks[piece[at:stop]])
        at = stop
    return ids


# Texts of these characters only are split by the compiler of the standard
# library, which is faster; the classes below hold every letter and number of them.
_PLAIN = [*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA0, 0x180)]
_PLAIN_TEXT = re.compile("[%s]*" % re.escape("".join(map(chr, _PLAIN))))


def _members(kind: str) -> str:
    return re.escape("".join(chr(c) for c in _PLAIN if unicodedata.category(chr(c))[0] == kind))


def plain_pattern(pattern: str) -> re.Pattern:
    r"""The pattern with \p{L} and \p{N} spelled out for plain texts."""
    classes = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_members('L')}{_members('N')}]")
    classes = classes.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    classes = classes.replace(r"\p{L}", f"[{_members('L')}]").replace(r"\p{N}", f"[{_members('N')}]")
    return re.compile(classes)


class Splitter:
    """All matches of the pattern in a text."""

    def __init__(self, pattern: str):
        self.plain, self.any = plain_pattern(pattern), regex.compile(pattern)

    def __call__(self, text: str) -> list[str]:
        plain = _PLAIN_TEXT.fullmatch(text)
        return self.plain.findall(text) if plain else self.any.findall(text)


class Encoder(dict):
    """Packed ids of pre-tokens, resolved on first sight."""

    def __init__(self, items: list[tuple[bytes, int]], pattern: str):
        super().__init__()
        self.whole, self.ranks = PerfectHash(items), dict(items)
        self.split = Splitter(pattern)

    def resolve(self, piece: bytes) -> bytes:
        rank = self.whole.find(piece)
        ids = [rank] if rank is not None else merge_bytes(piece, self.ranks)
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        packed = self.resolve(raw)
        if len(raw) <= MEMO_BYTES:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))


class Decoder:
    def __init__(self, items: list[tuple[bytes, int]]):
        self.tokens = {rank: token for token, rank in items}

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _tables(vocabulary, pattern: str) -> tuple[Encoder, Decoder]:
    items = vocabulary.value
    return held(("bpe", vocabulary.id, pattern), lambda: (Encoder(items, pattern), Decoder(items)))


class _Shared:
    """A broadcast vocabulary that the caches of workers know by its content."""

    def __init__(self, broadcast, digest: str):
        self.broadcast, self.id = broadcast, digest

    def __hash__(self):
        return hash(self.id)

    def __eq__(self, other):
        return self.id == other.id

    @property
    def value(self):
        return self.broadcast.value


def share_vocabulary(spark: SparkSession, path: str) -> _Shared:
    """Read a rank file on the driver and hand it to the tasks."""
    ranks = read_ranks(path)
    return _Shared(spark.sparkContext.broadcast(ranks), hashlib.sha256(repr(ranks).encode()).hexdigest())


def encode(docs: DataFrame, vocabulary: _Shared, pattern: str, key: str = "doc_id") -> DataFrame:
    """``key, ids``: the token ids of each text as little-endian unsigned 32-bit.

    Every row gives one row, repeated rows too.  A null or empty text has no ids.
    Special tokens are not recognised: their text is ordinary text.
    """
    kind = docs.schema[key].dataType.simpleString()

    importable_in_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _tables(vocabulary, pattern)
        for batch in batches:
            for part in slices(batch):
                ids = [encoder.encode(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(ids, pa.binary())], names=["key", "ids"]
                )
        encoder.clear()  # workers outlive their tasks

    rows = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    return rows.mapInArrow(tidy(run), f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocabulary: _Shared, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The same rows with the bytes that the ids stand for.  Null ids give no bytes."""
    schema = encoded.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoder = held(("decoder", vocabulary.id), lambda: Decoder(vocabulary.value))
        out = [decoder.decode(packed or b"") for packed in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, into]
        )

    return map_batches(encoded, run, f"{fields}, `{into}` binary")


def encode_digests(
    docs: DataFrame, vocabulary: _Shared, pattern: str, key: str = "doc_id", keep_ids: bool = False
) -> DataFrame:
    """Encode, decode, and give counts and digests; the ids themselves on demand.

    One pass: the decoded bytes stay in the task that made the ids, and a core needs one
    Python worker only.
    """
    kind = docs.schema[key].dataType.simpleString()
    importable_in_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tables(vocabulary, pattern)
        try:
            for batch in batches:
                for part in slices(batch, 256):
                    ids = [encoder.encode(text) for text in part.column("text").to_pylist()]
                    columns = {
                        "key": part.column("key"),
                        "n_tokens": pa.array([len(packed) // 4 for packed in ids], pa.int64()),
                        **({"ids": pa.array(ids, pa.binary())} if keep_ids else {}),
                        "ids_sha256": pa.array([hashlib.sha256(packed).hexdigest() for packed in ids]),
                        "decoded_sha256": pa.array([hashlib.sha256(decoder.decode(packed)).hexdigest() for packed in ids]),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        finally:
            encoder.clear()  # workers outlive their tasks

    rows = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    ids = "ids binary, " if keep_ids else ""
    schema = f"key {kind}, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)
