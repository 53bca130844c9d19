"""Removal of passages that repeat anywhere in the corpus, byte for byte.

A byte goes when a string of ``MATCH`` bytes covers it that also starts elsewhere.
Suffixes are compared through prefix polynomial hashes: a binary search over them
finds the common extension of two suffixes in logarithmic time, and a mergesort on
that comparison yields suffix order and common extensions of neighbours.

Not every suffix has to be sorted.  Among the grams of ``GRAM`` bytes inside a string
of ``MATCH`` bytes, the ones with the least hash are its anchors.  They depend on the
string alone, so two equal strings have anchors at equal places, and a repeat is
found by comparing the surroundings of anchors with equal grams only.  About one byte
in 150 starts an anchor.

1. Every text gives its anchors, with a digest of the bytes around each.  Staged.
2. Anchors are counted by gram, combined inside tasks first.  Most occur once and
   are done.  Where all surroundings of a gram are equal, all of them repeat whole.
3. The rest, one row for each different surrounding, gets its bytes from the text
   and is suffix-sorted together with the others of its gram.  A gram with very
   many different surroundings is not gathered: its windows are counted instead.
4. The spans meet the texts again by digest of the text.

Copies of a text share its digest, so they meet once, however many there are.

Besides, passages of ``WORDS`` words that another row has too are found, also those
under ``MATCH`` bytes and with other white space between their words.  Each window of
words belongs to its gram of ``WORD_GRAM`` words with the least hash.  Grams that differing
texts have are counted first; only windows of such grams are compared, by digest.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import importable_in_tasks, map_batches, text_key, text_of, tidy
from tripstrata.sources.scratch import scratch_dir

MATCH = 400
GRAM = 100
WINDOW = MATCH - GRAM + 1  # grams inside a match
LEFT, RIGHT = MATCH - GRAM, MATCH  # bytes around an anchor that matter
CHUNK = 1 << 18  # bytes of a text handled at once
SORT_ROWS = 4096  # surroundings sorted at once
GROUP_ROWS = 20_000  # beyond, a gram is not gathered in one task
ROUNDS = 64  # neighbours looked at on either side before windows are counted
WORDS = 51  # words of a passage that another row has too
WORD_GRAM = 12

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_PLACED = np.random.default_rng(20240301).integers(1, 1 << 63, 64 * 256, dtype=np.int64).astype(np.uint64)


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(18, int(size - 1).bit_length()))
    return up[:size], down[:size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes along the last axis, the empty one first."""
    up, _ = powers(data.shape[-1] + 1)
    sums = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum(_BYTES[data] * up[:-1], axis=-1, out=sums[..., 1:])
    return sums


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, from running minima of blocks in both directions."""
    size = len(values)
    blocks = np.full(-(-size // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:size] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: size - width + 1], ahead[width - 1 : size])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of all windows of a text."""
    places, hashes = [], []
    for start in range(0, len(data) - MATCH + 1, CHUNK):
        part = data[start : start + CHUNK + MATCH - 1]
        sums = prefix_hashes(part)
        _, down = powers(len(sums))
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        least = ~_sliding_min(grams, WINDOW)
        # A gram is an anchor when some window around it has it as its least.
        around = np.zeros(len(least) + 2 * (WINDOW - 1), np.uint64)
        around[WINDOW - 1 : WINDOW - 1 + len(least)] = ~least
        chosen = np.flatnonzero(~_sliding_min(~around, WINDOW) == grams)
        places.append(chosen + start)
        hashes.append(grams[chosen])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place, index = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[index]


_ANCHOR = "id {kind}, text_key binary, pos int, anchor long, c1 long, c2 long"


def find_anchors(texts: DataFrame) -> DataFrame:
    """Anchors of rows ``id, text_key, text``, each with a 128-bit digest of its surroundings."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, keys, place, gram, digest = [], [], [], [], []
        for row, (key, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            raw = text.encode("utf-8", "surrogatepass")
            if len(raw) < MATCH:
                continue
            pos, found = anchors(np.frombuffer(raw, np.uint8))
            rows += [row] * len(pos)
            keys += [key] * len(pos)
            place.append(pos)
            gram.append(found)
            for p in pos.tolist():
                left = min(p, LEFT)
                digest.append(xxhash.xxh3_128_digest(raw[p - left : p + RIGHT], seed=left))
        place.append(np.empty(0, np.int64))
        gram.append(np.empty(0, np.uint64))
        both = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(keys, pa.binary()),
                pa.array(np.concatenate(place).astype(np.int32)),
                pa.array(np.concatenate(gram).view(np.int64)),
                pa.array(both[:, 0]),
                pa.array(both[:, 1]),
            ],
            names=["id", "text_key", "pos", "anchor", "c1", "c2"],
        )

    return map_batches(texts, run, _ANCHOR.format(kind=kind), rows=256)


def split_words(raw: bytes) -> tuple[bytes, np.ndarray]:
    """Words with a space after each, and where they begin, the end of the last one included."""
    text = b" ".join([*raw.split(), b""])
    return text, np.concatenate([[0], np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1])


def least_grams(text: bytes, starts: np.ndarray) -> np.ndarray:
    """Least hash of the grams inside each window of ``WORDS`` words; it depends on the window alone."""
    size = len(starts) - 1
    if size < WORDS:
        return np.empty(0, np.uint64)
    words, at = np.empty(size, np.uint64), 0
    while at < size:
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK, side="right")) - 1)
        part = starts[at : stop + 1] - starts[at]
        data = np.frombuffer(text, np.uint8, int(part[-1]), int(starts[at]))
        place = (np.arange(len(data)) - np.repeat(part[:-1], np.diff(part))) & 63
        words[at:stop] = np.add.reduceat(_PLACED[place << 8 | data], part[:-1])
        at = stop
    grams = {1: words}
    for one, two in ((1, 1), (2, 2), (4, 4), (8, 4)):
        left, right = grams[one], grams[two][one:]
        grams[one + two] = _mixed(left[: len(right)] * _BASE + right)
    return _sliding_min(grams[WORD_GRAM], WORDS - WORD_GRAM + 1)


def find_word_anchors(texts: DataFrame) -> DataFrame:
    """``text_key, gram``: least grams of the windows of rows ``text_key, text``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        # All texts of a batch at once; windows that reach into the next text are left out.
        parts = [split_words(text.encode("utf-8", "surrogatepass")) for text in batch.column(1).to_pylist()]
        counts = np.array([len(starts) - 1 for _, starts in parts], np.int64)
        ends = np.cumsum([0, *[len(text) for text, _ in parts]])
        starts = np.concatenate([*[starts[:-1] + end for (_, starts), end in zip(parts, ends)], ends[-1:]])
        least = least_grams(b"".join(text for text, _ in parts), starts)
        owner = np.repeat(np.arange(len(parts)), counts)
        inside = np.flatnonzero(owner[: len(least)] == owner[WORDS - 1 :])
        least, owner = least[inside], owner[inside]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner[new])), pa.array(least[new].view(np.int64))], names=["text_key", "gram"]
        )

    return map_batches(texts, run, "text_key binary, gram long", rows=64)


class Suffixes:
    """Suffixes of a fixed width that are compared inside their groups.

    Rows must come with groups together.
    """

    def __init__(self, group: np.ndarray, rows: list[bytes], width: int):
        self.group, self.size, self.width = group, len(group), width
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in rows), np.uint8)
        self.data = data.reshape(len(rows), width)
        self.lengths = np.array([len(x) for x in rows], np.int64)
        self.sums = prefix_hashes(self.data)

    def extend(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common extension of rows x and y, by binary search for the longest equal prefix."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.lengths[x], self.lengths[y])
        for _ in range(self.width.bit_length()):
            middle = (low + high + 1) // 2
            equal = self.sums[x, middle] == self.sums[y, middle]
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
            high = np.maximum(low, high)
        return low

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before suffix y; the shorter of two prefixes first."""
        same = self.extend(x, y)
        at = np.minimum(same, self.width - 1)
        ends_x, ends_y = same >= self.lengths[x], same >= self.lengths[y]
        less = np.where(ends_x | ends_y, ends_x & ~ends_y, self.data[x, at] < self.data[y, at])
        return less | (ends_x & ends_y & (x < y))

    def sorted(self) -> np.ndarray:
        """Suffix order inside each group.

        Bottom-up mergesort: both halves of every pair of runs are placed at once, each
        suffix by binary search for its rank in the other half.
        """
        order, run = np.arange(self.size), 1
        longest = int(np.bincount(self.group).max()) if self.size else 0
        place = np.arange(self.size)
        starts = np.searchsorted(self.group, self.group)
        stops = np.searchsorted(self.group, self.group, side="right")
        while run < longest:
            offset = place - starts
            head = starts + offset // (2 * run) * (2 * run)
            second = offset % (2 * run) >= run
            other_from = np.where(second, head, np.minimum(head + run, stops))
            other_to = np.where(second, np.minimum(head + run, stops), np.minimum(head + 2 * run, stops))
            low, high = other_from.copy(), other_to.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                smaller = self.before(order[middle], order[open_])
                low[open_] = np.where(smaller, middle + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], middle)
            own = np.where(second, place - head - run, place - head)
            merged = np.empty_like(order)
            merged[head + own + (low - other_from)] = order
            order, run = merged, 2 * run
        return order

    def neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffix order, extension shared with the one before in it, and per row the
        longest extension shared with any other of its group."""
        order = self.sorted()
        near = np.zeros(self.size + 1, np.int64)
        same = np.flatnonzero(self.group[order[1:]] == self.group[order[:-1]]) + 1
        near[same] = self.extend(order[same], order[same - 1])
        longest = np.empty(self.size, np.int64)
        longest[order] = np.maximum(near[:-1], near[1:])
        return order, near, longest

    def confirmed(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The extension as its bytes confirm it; a hash collision is cut short."""
        differ = self.data[x] != self.data[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
        return np.minimum(size, first)


class Surroundings:
    """Bytes around anchors: suffixes to the right, and to the left, read backwards."""

    def __init__(self, group: np.ndarray, left: list[bytes], right: list[bytes]):
        self.group, self.size = group, len(group)
        self.right = Suffixes(group, right, RIGHT)
        self.left = Suffixes(group, [x[::-1] for x in left], LEFT)


def repeats(around: Surroundings) -> tuple[np.ndarray, np.ndarray]:
    """Bytes to the left and right of each anchor that windows shared with others cover.

    Neighbours in suffix order share the longest extensions.  Where the longest on the
    left and on the right together are too short for a window there is none.  Else,
    walking away from a suffix, the right extension only shrinks, so the walk ends when
    the left one is as long as any, or when no window fits.
    """
    size = around.size
    left, right = around.left, around.right
    best_left, best_right = np.zeros(size, np.int64), np.zeros(size, np.int64)
    _, _, most = left.neighbours()
    order, near, _ = right.neighbours()
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    late = np.zeros(size, bool)
    for side in (-1, 1):
        active = np.arange(size)
        shared = np.full(size, RIGHT, np.int64)
        side_left, side_right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for step in range(1, ROUNDS + 1):
            at = rank[active] + side * step
            inside = (at >= 0) & (at < size)
            active, at = active[inside], at[inside]
            shared[active] = np.minimum(shared[active], near[np.where(side < 0, at + 1, at)])
            going = shared[active] + most[active] >= MATCH
            going &= (side_left[active] < most[active]) | (side_right[active] == 0)
            active, at = active[going], at[going]
            if not len(active):
                break
            other = order[at]
            found = left.extend(active, other)
            fits = found + shared[active] >= MATCH
            x, y = active[fits], other[fits]
            sure_left = left.confirmed(x, y, found[fits])
            sure_right = right.confirmed(x, y, shared[x])
            sure = sure_left + sure_right >= MATCH
            x, sure_left, sure_right = x[sure], sure_left[sure], sure_right[sure]
            side_left[x] = np.maximum(side_left[x], sure_left)
            side_right[x] = np.maximum(side_right[x], sure_right)
        best_left, best_right = np.maximum(best_left, side_left), np.maximum(best_right, side_right)
        late[active] = True
    # Those still walking: count the windows of their groups, column by column.
    if late.any():
        rows = np.flatnonzero(np.isin(around.group, np.unique(around.group[late])))
        for before in range(LEFT + 1):
            have = rows[(most[rows] >= before) & (right.lengths[rows] >= MATCH - before)]
            ids = window_digests(around, have, before)
            by = np.lexsort((ids, around.group[have]))
            have, ids = have[by], ids[by]
            equal = (ids[1:] == ids[:-1]) & (around.group[have[1:]] == around.group[have[:-1]])
            twice = have[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])] if len(have) else have
            best_left[twice] = np.maximum(best_left[twice], before)
            best_right[twice] = np.maximum(best_right[twice], MATCH - before)
    return best_left, best_right


def window_digests(around: Surroundings, rows: np.ndarray, left: int) -> np.ndarray:
    """A number for the window that starts ``left`` bytes before each anchor.

    Both parts have a fixed length, so their prefix hashes stand for the bytes.
    """
    return _mixed(around.left.sums[rows, left]) + around.right.sums[rows, MATCH - left]


_SIDES = "anchor long, c1 long, c2 long, left binary, right binary"
_FOUND = "anchor long, c1 long, c2 long, covers_left int, covers_right int"


_WINDOWS = "text_key binary, place int, times int, w1 long, w2 long"


def cut_texts(texts: DataFrame) -> DataFrame:
    """Surroundings and windows of words, each with nulls for the columns of the other.

    Rows are ``text_key, text, wanted`` (array of anchor, c1, c2, pos) and ``grams`` (array).
    Equal windows that follow each other, as one word again and again gives, are one row.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides, keys, places, times, digests = [], [], [], [], []
        for key, text, wanted, grams in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for w in wanted or ():
                p = w["pos"]
                sides.append((w["anchor"], w["c1"], w["c2"], raw[max(0, p - LEFT) : p], raw[p : p + RIGHT]))
            if grams:
                words, starts = split_words(raw)
                least = least_grams(words, starts).view(np.int64)
                own = np.flatnonzero(np.isin(least, np.array(grams, np.int64)))
                begin, end = starts[own].tolist(), starts[own + WORDS].tolist()
                digest = [xxhash.xxh3_128_digest(words[x:y]) for x, y in zip(begin, end)]
                new = [n for n, d in enumerate(digest) if not n or d != digest[n - 1] or own[n] != own[n - 1] + 1]
                digests += [digest[n] for n in new]
                places += own[new].tolist()
                times += np.diff([*new, len(own)]).tolist()
                keys += [key] * len(new)
        both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [*(zip(*sides) if sides else [()] * 5), keys, places, times, both[:, 0], both[:, 1]]
        types = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([a, pa.nulls(len(keys), a.type)] if n < 5 else [pa.nulls(len(sides), a.type), a])
                for n, a in enumerate(arrays)
            ],
            names=["anchor", "c1", "c2", "left", "right", "text_key", "place", "times", "w1", "w2"],
        )

    return map_batches(texts, run, f"{_SIDES}, {_WINDOWS}", rows=128)


def _shared_places(windows: DataFrame, path: str) -> DataFrame:
    """``text_key, places``: numbers of the words at which windows begin that differing texts have.

    ``times`` of a place says how many windows in a row begin there.
    """
    text = F.xxhash64("text_key")
    # Staged, so that the join can split the rows of a very common window.
    twice = windows.groupBy("w1", "w2").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    twice.filter("low <> high").select("w1", "w2").write.parquet(path)
    return (
        windows.join(windows.sparkSession.read.parquet(path), ["w1", "w2"])
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set(F.struct("place", "times"))).alias("places"))
    )


def _sort_groups(sides: DataFrame) -> DataFrame:
    """Suffix-sort rows that come in the order of anchor, c1 and c2."""
    importable_in_tasks(sides.sparkSession)

    def solve(table: pa.Table) -> pa.RecordBatch:
        # Rows that repeat an id and a text gave the same surrounding twice.
        names = [table.column(c).to_numpy() for c in ("anchor", "c1", "c2")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in names], axis=0)
        table = table.filter(pa.array(new))
        anchor = table.column("anchor").to_numpy()
        group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]])).astype(np.int64)
        around = Surroundings(group, table.column("left").to_pylist(), table.column("right").to_pylist())
        left, right = repeats(around)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor),
                *[pa.array(table.column(c).to_numpy()) for c in ("c1", "c2")],
                pa.array(left.astype(np.int32)),
                pa.array(right.astype(np.int32)),
            ],
            names=["anchor", "c1", "c2", "covers_left", "covers_right"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            if held.num_rows < SORT_ROWS:
                continue
            anchor = held.column("anchor").to_numpy()
            earlier = np.flatnonzero(anchor != anchor[-1])
            whole = int(earlier[-1]) + 1 if len(earlier) else 0
            if whole:
                yield solve(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield solve(held)

    return sides.mapInArrow(tidy(run), _FOUND)


def _count_windows(sides: DataFrame) -> DataFrame:
    """The same result for grams with very many surroundings: windows are counted.

    Nothing is gathered by gram; each window of each surrounding is a row of an
    aggregate, keyed by a 128-bit digest of its bytes.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for a, c1, c2, left, right in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            whole, at = left + right, len(left)
            for start in range(max(0, len(whole) - MATCH + 1)):
                if start > at:
                    break
                window = xxhash.xxh3_128_digest(whole[start : start + MATCH], seed=at - start)
                rows.append((a, c1, c2, at - start, window))
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["anchor", "c1", "c2", "before", "window"]
        )

    windows = map_batches(sides, run, "anchor long, c1 long, c2 long, before int, window binary", rows=64)
    twice = (
        windows.groupBy("anchor", "before", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    return (
        windows.join(twice, ["anchor", "before", "window"], "left_semi")
        .groupBy("anchor", "c1", "c2")
        .agg(F.max("before").alias("covers_left"), (F.lit(MATCH) - F.min("before")).cast("int").alias("covers_right"))
    )


def repeated_spans(docs: DataFrame, key: str = "doc_id", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``text_key, spans, places, copied``: for each text with repeats, (start, stop) pairs in bytes.

    Spans may overlap; each is covered by windows that also start elsewhere.  ``places``
    are the words, counted from 0, at which ``WORDS`` words begin that a differing text has
    too, each with the ``times`` that words after it begin the same; ``copied`` says that another row has the whole text.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "repeats")
    texts = docs.select(F.col(key).alias("id"), text_key(text_of()).alias("text_key"), text_of().alias("text"))
    wordy = texts.filter(F.octet_length("text") >= 2 * WORDS - 1)
    texts = texts.filter(F.octet_length("text") >= MATCH)
    find_anchors(texts).write.parquet(f"{path}/anchors")
    found = spark.read.parquet(f"{path}/anchors")

    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in ("c1", "c2") for f in (F.min, F.max)]
    mixed = (F.col("min_c1") != F.col("max_c1")) | (F.col("min_c2") != F.col("max_c2"))
    (
        found.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), *bounds)
        .filter("n > 1")
        .select("anchor", mixed.alias("mixed"))
        .write.parquet(f"{path}/shared")
    )
    shared = spark.read.parquet(f"{path}/shared")
    again = found.join(shared, "anchor")
    again.write.parquet(f"{path}/again")
    again = spark.read.parquet(f"{path}/again")

    # One row for each different surrounding of a gram; any of its places will do.
    (
        again.filter("mixed")
        .groupBy("anchor", "c1", "c2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text_key", "id", "pos")).alias("at"))
        .write.parquet(f"{path}/kinds")
    )
    kinds = spark.read.parquet(f"{path}/kinds")
    place = F.struct("anchor", "c1", "c2", F.col("at.pos").alias("pos"))
    (
        kinds.groupBy(F.col("at.text_key").alias("wanted_key"), F.col("at.id").alias("wanted_id"))
        .agg(F.collect_list(place).alias("wanted"))
        .write.parquet(f"{path}/wanted")
    )
    wanted = spark.read.parquet(f"{path}/wanted")

    find_word_anchors(wordy.select("text_key", "text")).write.parquet(f"{path}/grams")
    grams = spark.read.parquet(f"{path}/grams")
    text = F.xxhash64("text_key")
    common = grams.groupBy("gram").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    common.filter("low <> high").select("gram").write.parquet(f"{path}/common")
    (
        grams.join(spark.read.parquet(f"{path}/common"), "gram")
        .groupBy("text_key")
        .agg(F.collect_set("gram").alias("grams"))
        .write.parquet(f"{path}/compared")
    )
    rows_of = wordy.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    rows_of.filter("n > 1").select("text_key", F.lit(True).alias("copied"), "first_id").write.parquet(f"{path}/copies")
    copies = spark.read.parquet(f"{path}/copies")
    compared = spark.read.parquet(f"{path}/compared").join(copies, "text_key", "left")
    compared = compared.withColumnRenamed("text_key", "compared_key")
    needed = wanted.join(compared, F.col("wanted_key") == F.col("compared_key"), "full")
    needed = needed.withColumn("needed_key", F.coalesce("wanted_key", "compared_key"))
    # Of the copies of a text only the one with the chosen id gives bytes.
    chosen = F.when(F.col("id").eqNullSafe(F.col("wanted_id")), F.col("wanted")).alias("wanted")
    first = F.when(F.col("copied").isNull() | F.col("id").eqNullSafe(F.col("first_id")), F.col("grams")).alias("grams")
    cut = wordy.join(needed, F.col("text_key") == F.col("needed_key")).select("text_key", "text", chosen, first)
    cut_texts(cut.filter("wanted IS NOT NULL OR grams IS NOT NULL")).write.parquet(f"{path}/cut")
    sides = spark.read.parquet(f"{path}/cut").filter("anchor IS NOT NULL").select("anchor", "c1", "c2", "left", "right")
    windows = spark.read.parquet(f"{path}/cut").filter("w1 IS NOT NULL").select("text_key", "place", "times", "w1", "w2")
    _shared_places(windows, f"{path}/twice").write.parquet(f"{path}/places")
    crowded = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows)
    crowded.select(F.col("anchor").alias("big")).write.parquet(f"{path}/crowded")
    crowded = spark.read.parquet(f"{path}/crowded")
    few = sides.join(crowded, F.col("anchor") == F.col("big"), "left_anti")
    together = few.repartition("anchor").sortWithinPartitions("anchor", "c1", "c2")
    _sort_groups(together).write.parquet(f"{path}/sorted")
    covers = spark.read.parquet(f"{path}/sorted")
    if not crowded.isEmpty():
        many = sides.join(crowded, F.col("anchor") == F.col("big"), "left_semi")
        many.dropDuplicates(["anchor", "c1", "c2"]).write.parquet(f"{path}/many")
        covers = covers.unionByName(_count_windows(spark.read.parquet(f"{path}/many")))

    # A surrounding that occurs twice repeats whole, as do all of a gram that is not mixed.
    whole_left, whole_right = F.lit(LEFT).alias("covers_left"), F.lit(RIGHT).alias("covers_right")
    partial = (
        kinds.select("anchor", "c1", "c2", "n")
        .join(covers, ["anchor", "c1", "c2"], "left")
        .select(
            "anchor",
            "c1",
            "c2",
            F.when(F.col("n") > 1, LEFT).otherwise(F.coalesce("covers_left", F.lit(0))).alias("covers_left"),
            F.when(F.col("n") > 1, RIGHT).otherwise(F.coalesce("covers_right", F.lit(0))).alias("covers_right"),
        )
        .filter("covers_right > 0")
    )
    partial.write.parquet(f"{path}/partial")
    partial = spark.read.parquet(f"{path}/partial")
    spans = again.filter("NOT mixed").select("text_key", "pos", whole_left, whole_right).unionByName(
        again.filter("mixed").join(partial, ["anchor", "c1", "c2"]).select("text_key", "pos", "covers_left", "covers_right")
    )
    start = F.greatest(F.col("pos") - F.col("covers_left"), F.lit(0))
    return (
        spans.select("text_key", start.alias("start"), (F.col("pos") + F.col("covers_right")).alias("stop"))
        .distinct()
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
        .join(spark.read.parquet(f"{path}/places"), "text_key", "full")
        .join(copies.drop("first_id"), "text_key", "full")
    )


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs from spans in order; spans shorter than a match hold no window."""
    runs: list[tuple[int, int]] = []
    for span in spans:
        start, stop = span["start"], min(span["stop"], size)
        if stop - start < MATCH:
            continue
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((start, stop))
    return runs


def drop_repeats(docs: DataFrame, key: str = "doc_id", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept, n_shared_words`` per row; ``kept`` are the bytes that stay.

    Null reads as an empty text.  Texts under ``MATCH`` bytes stay whole.  Rows with
    equal texts repeat each other: they lose all their bytes, if they have enough.
    ``n_shared_words`` are the words in passages of ``WORDS`` words that another row has
    too, whatever white space stands between them.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    path = scratch_dir(spark, "repeat-spans")
    repeated_spans(docs, key, group_rows).write.parquet(path)
    spans = spark.read.parquet(path)
    rows = docs.select(F.col(key).alias("key"), text_key(text_of()).alias("text_key"), text_of().alias("text"))
    joined = rows.join(spans, "text_key", "left").select("key", "text", "spans", "places", "copied")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, counts, kept, shared = [], [], [], [], []
        for _, text, found, places, copied in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            runs = _merged(found or [], len(raw))
            edges = [0, *[e for r in runs for e in r], len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(raw))
            removed.append(len(raw) - len(kept[-1]))
            counts.append(len(runs))
            if copied:
                words = len(raw.split())
                shared.append(words if words >= WORDS else 0)
            else:
                at = np.array([(p["place"], p["place"] + p["times"] - 1 + WORDS) for p in places or ()]).reshape(-1, 2)
                last = np.maximum.accumulate(np.concatenate([[0], at[:, 1]]))
                shared.append(int(np.maximum(at[:, 1] - np.maximum(at[:, 0], last[:-1]), 0).sum()))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array(shared, pa.int64()),
            ],
            names=["key", "n_bytes", "n_removed", "n_spans", "kept", "n_shared_words"],
        )

    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary, n_shared_words long"
    return map_batches(joined, run, schema).withColumnRenamed("key", key)
