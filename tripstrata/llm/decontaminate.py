"""Benchmark decontamination by Wu-Manber search over words.

The windows of the benchmark items are the search patterns, words are the
letters.  For windows of at least ``m`` words, a table gives for each block of two
words how far it stands from the end of the first ``m`` words of any window.  The
search looks at one block, skips as many words as the table allows (``m - 1`` for
a block in no window, which is nearly all of them), and only where the shift is
zero takes the bucket of that block as suffix, picks by the first word and compares
the whole window.  Windows of different lengths have tables of their own, so a
short item does not shorten the skips of the others.

Documents stay where they are: no shuffle.  The benchmark goes out in blocks of a
checked size; the documents pass through one block after another, in the same
stage, so a benchmark of any size is searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tripstrata.llm.common import held, map_batches, text_of

WINDOW = 13
# Text of the benchmark that one broadcast block may hold.
BLOCK_BYTES = 16 << 20
# Share of hit words from which a document counts as contaminated: 1 / 20.
HIT_DIVISOR = 20

# Fixed by the contract: words are runs of ASCII letters and digits and of all
# characters above ASCII; letters A-Z are lowered.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of an item; a shorter item is one window, an empty one none."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Finds all occurrences of patterns of one length in a list of words."""

    def __init__(self, patterns: list[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(2, length)
        self.shifts: dict = {}
        self.buckets: dict = {}
        for number, pattern in enumerate(patterns):
            for stop in range(self.block, length + 1):
                block = self._key(pattern, stop)
                shift = length - stop
                self.shifts[block] = min(shift, self.shifts.get(block, shift))
            by_first = self.buckets.setdefault(self._key(pattern, length), {})
            by_first.setdefault(pattern[0], []).append((pattern, number))

    def _key(self, words, stop: int):
        return words[stop - 1] if self.block == 1 else (words[stop - 2], words[stop - 1])

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """``(start, pattern number)`` of every occurrence, overlapping ones too."""
        length, shifts, size = self.length, self.shifts, len(words)
        furthest = length - self.block + 1
        stop = length
        while stop <= size:
            key = words[stop - 1] if self.block == 1 else (words[stop - 2], words[stop - 1])
            shift = shifts.get(key, furthest)
            if shift:
                stop += shift
                continue
            start = stop - length
            for pattern, number in self.buckets[key].get(words[start], ()):
                if tuple(words[start:stop]) == pattern:
                    yield start, number
            stop += 1


class Matcher:
    """Windows of a block of items, with the items that own each window."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            for window in windows_of(words_of(text), size):
                owners.setdefault(window, set()).add(item)
        by_length: dict[int, list] = {}
        for window in owners:
            by_length.setdefault(len(window), []).append(window)
        self.searches = [
            (WuManber(patterns, length), [sorted(owners[p]) for p in patterns])
            for length, patterns in sorted(by_length.items())
        ]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words and the items whose windows occur."""
        spans, items = [], set()
        for search, owners in self.searches:
            for start, number in search.find(words):
                spans.append((start, start + search.length))
                items.update(owners[number])
        return spans, items


def item_blocks(benchmark: DataFrame, item: str = "item_id", limit: int = BLOCK_BYTES) -> Iterator[list]:
    """The items in blocks of bounded text, read one partition at a time; at least one block."""
    block, held, given = [], 0, False
    rows = benchmark.select(F.col(item).cast("string"), text_of()).filter(F.col(item).isNotNull())
    for name, text in rows.toLocalIterator():
        if block and held + len(text) > limit:
            yield block
            block, held, given = [], 0, True
        block.append((name, text))
        held += len(text)
    if block or not given:
        yield block


def _matcher(shared, size: int) -> Matcher:
    return held(("matcher", shared.name, size), lambda: Matcher(shared.items.value, size))


class _Shared:
    """A broadcast block that a worker's cache knows by name."""

    def __init__(self, items):
        self.name, self.items = uuid4().hex, items

    def __hash__(self):
        return hash(self.name)

    def __eq__(self, other):
        return self.name == other.name


def _state(kind: DataType) -> StructType:
    fields = StructType.fromDDL("text string, hits binary, items array<string>, n_words long, n_hit long")
    return StructType([StructField("key", kind), *fields])


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, n_words, n_hit, n_items, items, items_sha256, contaminated`` per row.

    A word inside any occurrence of a benchmark window is hit.  A row counts as
    contaminated when something is hit and at least one word in twenty is.  Null
    and empty texts have no words and are clean.  Items without text or id own no
    windows; items that repeat, or share a window, are each counted once.
    """
    spark = docs.sparkSession
    state = _state(docs.schema[key].dataType)
    rows = docs.select(
        F.col(key).alias("key"),
        text_of().alias("text"),
        F.lit(None).cast("binary").alias("hits"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for block in item_blocks(benchmark, item, block_bytes):
        shared = _Shared(spark.sparkContext.broadcast(block))

        def search(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            matcher = _matcher(shared, window)
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            n_words, n_hit = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                spans, found = matcher.hits(words)
                marks = np.zeros(len(words), dtype=bool)
                if hits[row] is not None:
                    marks |= np.unpackbits(np.frombuffer(hits[row], np.uint8), count=len(words)).view(bool)
                for start, stop in spans:
                    marks[start:stop] = True
                if spans:
                    hits[row] = np.packbits(marks).tobytes()
                    items[row] = sorted(found.union(items[row] or ()))
                n_words.append(len(words))
                n_hit.append(int(marks.sum()))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text"),
                    pa.array(hits, pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                ],
                names=["key", "text", "hits", "items", "n_words", "n_hit"],
            )

        rows = map_batches(rows, search, state)
    found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("key").alias(key),
        "n_words",
        "n_hit",
        F.size(found).cast("long").alias("n_items"),
        found.alias("items"),
        F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * HIT_DIVISOR >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged; no shuffle.

    Whole rows travel through the search as its key.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    found = find_windows(rows, benchmark, key="_doc", **options)
    return found.filter(~F.col("contaminated")).select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
