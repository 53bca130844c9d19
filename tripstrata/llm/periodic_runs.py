r"""Runs of words that repeat with a period, found and collapsed to one period.

A run is a stretch of words of smallest period ``q`` (words ``q`` apart are equal), at
least ``LEAST_WORDS`` and ``EXPONENT * q`` words long, that no neighbouring word extends.

Every word of a run occurs in it ``EXPONENT`` times at least.  So a word that is rarer
than that within a segment of the text belongs to no run there, and splits it.  The
parts are smaller, more words are too rare in them, and so on until nothing splits
any more; in ordinary prose nothing is left by then.  What survives is scanned lag by
lag.

A scan of a segment of m words compares, for each lag q, the hashes of m / q blocks of
q words: a run of four periods holds three whole blocks, wherever it starts.  That is
m log m for all lags.  Where neighbouring blocks agree, a binary search over prefix
hashes finds how far the period reaches, and a comparison of the words confirms it.
When hashes misled, the lag is scanned word by word, so the result is exact.

One map over rows without a shuffle: texts are judged on their own.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import map_batches, text_of

LEAST_WORDS = 6
EXPONENT = 4
WORD = r"[^\x20\x09-\x0D]+"

_BASE = (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, counted from 0."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def frequent_segments(
    words: np.ndarray, least_count: int = EXPONENT, least_words: int = LEAST_WORDS
) -> list[tuple[int, int]]:
    """Longest stretches in which every word occurs ``least_count`` times or more.

    Each round looks again only at the segments that the round before has split.
    """
    distinct = int(words.max()) + 1 if len(words) else 0
    found, at = [], np.arange(len(words))
    while len(at):
        label = np.cumsum(np.concatenate([[0], np.diff(at) != 1]))
        at = at[np.bincount(label)[label] >= least_words]
        if not len(at):
            break
        first = np.concatenate([[True], np.diff(at) != 1])
        label = np.cumsum(first) - 1
        _, inverse, counts = np.unique(label * distinct + words[at], return_inverse=True, return_counts=True)
        rare = counts[inverse] < least_count
        split = np.zeros(label[-1] + 1, bool)
        split[label[rare]] = True
        starts = np.flatnonzero(first)
        stops = np.append(starts[1:], len(at))
        whole = ~split
        found += zip(at[starts[whole]].tolist(), (at[stops[whole] - 1] + 1).tolist(), strict=True)
        at = at[split[label] & ~rare]
    return sorted(found)


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    ones = [np.full(size, base, np.uint64) for base in _BASE]
    for powers in ones:
        powers[0] = 1
    return np.multiply.accumulate(ones[0]), np.multiply.accumulate(ones[1])


class _Segment:
    """One segment with the hashes of its prefixes, modulo 2 ** 64."""

    def __init__(self, words: np.ndarray):
        self.words, size = words, len(words)
        up, self.down = _powers(1 << max(17, size.bit_length()))
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(mixed * up[:size], out=self.sums[1:])

    def same(self, a: int, b: int, length: int) -> bool:
        sums, down = self.sums, self.down
        return (sums[a + length] - sums[a]) * down[a] == (sums[b + length] - sums[b]) * down[b]

    def agreeing_blocks(self, lag: int) -> np.ndarray:
        """Starts of blocks of ``lag`` words that the next two blocks repeat."""
        edges = np.arange(0, len(self.words) + 1, lag)
        sums = self.sums[edges]
        blocks = (sums[1:] - sums[:-1]) * self.down[edges[:-1]]
        equal = blocks[1:] == blocks[:-1]
        return edges[np.flatnonzero(equal[1:] & equal[:-1])]

    def reach(self, start: int, lag: int) -> tuple[int, int]:
        """The stretch with that period around a block, as the hashes have it."""
        low, high = 0, len(self.words) - start - lag  # words ahead that surely, may agree
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(start, start + lag, middle) else (low, middle - 1)
        stop = start + lag + low
        low, high = 0, start
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start - middle, start - middle + lag, middle):
                low = middle
            else:
                high = middle - 1
        return start - low, stop

    def confirmed(self, start: int, stop: int, lag: int) -> bool:
        """Whether the words say the same, at both ends too."""
        w = self.words
        inside = np.array_equal(w[start : stop - lag], w[start + lag : stop])
        left = start == 0 or w[start - 1] != w[start - 1 + lag]
        right = stop == len(w) or w[stop] != w[stop - lag]
        return bool(inside and left and right)

    def scan_words(self, lag: int) -> list[tuple[int, int]]:
        equal = np.concatenate([[False], self.words[lag:] == self.words[:-lag], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        return [(a, b + lag) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def runs_of_segment(
    words: np.ndarray, exponent: int = EXPONENT, least_words: int = LEAST_WORDS
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, lag by lag."""
    segment, found = _Segment(words), {}
    for lag in range(1, len(words) // exponent + 1):
        starts = segment.agreeing_blocks(lag)
        stretches, at = [], 0
        while at < len(starts):
            start, stop = segment.reach(int(starts[at]), lag)
            # A stretch of a smaller period shows again at its multiples.
            known = found.get((start, stop))
            if known is None or lag % known:
                if not segment.confirmed(start, stop, lag):
                    stretches = segment.scan_words(lag)
                    break
                stretches.append((start, stop))
            at = max(at + 1, int(np.searchsorted(starts, stop - 2 * lag)))
        for start, stop in stretches:
            if stop - start >= max(least_words, exponent * lag):
                found.setdefault((start, stop), lag)
    return sorted((start, stop - start, lag) for (start, stop), lag in found.items())


def runs_of_words(
    words: np.ndarray, exponent: int = EXPONENT, least_words: int = LEAST_WORDS
) -> list[tuple[int, int, int]]:
    """All runs of a text, by start and then period."""
    found = []
    with np.errstate(over="ignore"):  # hashes wrap around
        for start, stop in frequent_segments(words, exponent, least_words):
            part = runs_of_segment(words[start:stop], exponent, least_words)
            found += [(start + s, length, period) for s, length, period in part]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is cut down to its first period."""
    change = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: Column | str = "text",
    exponent: int = EXPONENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``key, n_words, runs, collapsed`` for each row.

    Words are what ASCII white space separates, numbered from 0.  ``runs`` are by start
    and then period; ``collapsed`` has the words that no run holds beyond its first
    period, joined by one space.  A null text has no words; repeated rows each get
    their row, and no rows give none.  ``exponent`` is 4 at least.
    """
    if exponent < 4:
        raise ValueError("blocks find runs of four periods or more")
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, runs, collapsed = [], [], []
        for value in batch.column("text").to_pylist():
            words = value.encode("utf-8").split()
            found = runs_of_words(word_numbers(words), exponent, least_words)
            sizes.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            if found:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), found))]
            collapsed.append(b" ".join(words).decode("utf-8"))
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(collapsed)],
            names=["key", "n_words", "runs", "collapsed"],
        )

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    schema = f"key {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    return map_batches(rows, run, schema, rows=128).withColumnRenamed("key", key)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest length by period; of equal ones the first, then the shortest."""

    def better(best: Column, run: Column) -> Column:
        more = run.getField("length") * best.getField("period") > best.getField("length") * run.getField("period")
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def repeated_tails(text: Column | str, key: Column | str) -> Column:
    """The text with its tail made periodic, for one row in ten by the checksum of its key.

    From a word on, which the checksum picks, the words so far from there repeat.  The
    words are then joined by one space.  Other texts, and those of null keys, stay.
    """
    value = text_of(text)
    words = F.regexp_extract_all(value, F.lit(WORD), F.lit(0))
    number = F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary"))

    # Whole slices: a function of single words would split the text again for each.
    n, g = F.size(words).cast("long"), F.floor(number / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    first = F.slice(words, F.lit(1), a.cast("int"))
    period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (n - a).cast("int"))
    rebuilt = F.array_join(F.concat(first, tail), " ")

    chosen = (number % 10 == 0) & value.rlike(WORD)
    return F.when(chosen, rebuilt).otherwise(value)
