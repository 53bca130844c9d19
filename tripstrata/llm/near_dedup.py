"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A text is its shingles of five words, each with a weight: how often it occurs there,
damped, times how rare it is in the corpus.  Improved consistent weighted sampling
turns that into 48 samples, two of which agree with a probability equal to the
weighted Jaccard similarity.  Samples form twelve bands of four; texts that agree in
a band meet in its bucket, where pairs are verified on their whole shingle sets.

A text that repeats shingles has twelve more bands, from samples without the counts: it
then also meets texts that say the same less often.  Texts without repeats have
the same samples either way, so both kinds of bands share their buckets.

* Document frequencies are counted over all documents in hashed cells, 2^20 of them
  whatever the size of the corpus, so their table has a fixed size.  They weigh a
  shingle between 1 and 1.25: rare shingles tell texts apart a little more, and a
  group of copies that fills a third of the corpus still stays together.  Beyond some
  billion different shingles all cells are alike, and the weights tend to flat ones.
* Copies of a text share its 64-bit id and enter a bucket once.
* Buckets with the same members are verified once.  Inside a bucket pairs go in the
  order of their agreeing samples, and pairs that are connected already are skipped,
  so a bucket of n copies of one another costs n verifications.
* A bucket beyond ``BUCKET_TEXTS`` is dealt out to pairs of blocks: every pair of its
  texts still meets in some task, and no task holds more than two blocks.
* Verified links are joined into classes by star contraction, in tables.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import (
    broadcast_if_small,
    fits,
    importable_in_tasks,
    map_batches,
    rows_without,
    slices,
    text_of,
    tidy,
)
from tripstrata.llm.components import connected_components
from tripstrata.llm.decontaminate import _WORD_BYTES
from tripstrata.llm.suffix_dedup import _mixed, powers, prefix_hashes
from tripstrata.sources.scratch import scratch_dir

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
CELLS = 1 << 20  # of the document frequencies
CHUNKS = 64
IDF_SPREAD = 0.25
# Pairs with fewer agreeing samples of either kind are not verified: at a similarity of
# 0.8 the chance of so few is under one in a million.
LEAST_AGREEING = 24
BUCKET_TEXTS = 2000
TEXT_CHUNK = 1 << 22

_POOL = 4096
_random = np.random.default_rng(7919)
_R = _random.gamma(2.0, 1.0, _POOL)
_LOG_C = np.log(_random.gamma(2.0, 1.0, _POOL))
_BETA = _random.random(_POOL)
_FACTORS = _random.integers(1, 1 << 63, SAMPLES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _random.integers(1, 1 << 63, SHINGLE, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word: runs of letters and digits, A-Z lowered."""
    raw = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    found, start = [], 0
    while start < len(raw):
        stop = len(raw)
        if stop - start > TEXT_CHUNK:  # cut where a word ends
            stop = start + TEXT_CHUNK
            stop = max(raw.rfind(b" ", start, stop), start) + 1 if b" " in raw[start:stop] else stop
        data = np.frombuffer(raw, np.uint8, stop - start, start)
        inside = np.concatenate([[False], data != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        sums = prefix_hashes(data)
        _, down = powers(len(sums))
        found.append(_mixed((sums[last] - sums[first]) * down[first]))
        start = stop
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and how often each occurs.

    A text of fewer than five words, but not none, is one shingle.
    """
    words = word_hashes(text)
    if not len(words):
        return words, np.empty(0, np.int64)
    size = min(SHINGLE, len(words))
    count = len(words) - size + 1
    mixed = np.zeros(count, np.uint64)
    for j in range(size):
        mixed += words[j : j + count] * _PLACES[j]
    return np.unique(_mixed(mixed), return_counts=True)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Rows whose text has a shingle of the cell, for each of the cells."""
    importable_in_tasks(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch):
                found = [_cells(shingles(t)[0]) for t in part.column("text").to_pylist()]
                cells += np.bincount(np.concatenate([np.empty(0, np.int64), *found]), minlength=CELLS)
        blobs = [c.tobytes() for c in cells.reshape(CHUNKS, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "cells"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // CHUNKS, np.int64)
        for blob in table.column("cells"):
            total += np.frombuffer(blob.as_buffer(), np.int64)
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "cells": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, cells binary"
    summed = texts.select("text").mapInArrow(tidy(count), schema).groupBy("chunk").applyInArrow(add, schema)
    out = np.zeros((CHUNKS, CELLS // CHUNKS), np.int64)
    for row in summed.collect():  # CHUNKS rows of fixed size
        out[row.chunk] = np.frombuffer(row.cells, np.int64)
    return out.ravel()


def rarity(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Weight of a shingle by its cell, from 1 for everywhere to 1 + IDF_SPREAD for once.

    The mean of the cells is what other shingles add to a cell; it is taken off.
    """
    own = np.clip(frequencies - frequencies.mean(), 1, max(documents, 1))
    share = np.log(max(documents, 1) / own) / np.log(max(documents, 2))
    return (1 + IDF_SPREAD * share).astype(np.float32)


class _Weights:
    """The broadcast rarities, known to a worker's cache by name."""

    def __init__(self, broadcast):
        self.name, self.broadcast = uuid4().hex, broadcast

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Shingles, their weights, and the weights without counts where those differ."""
        hashes, counts = shingles(text)
        rare = self.broadcast.value[_cells(hashes)]
        if not (counts > 1).any():
            return hashes, rare, None
        return hashes, (1 + np.log(counts)).astype(np.float32) * rare, rare


def sample(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Improved consistent weighted samples, one 32-bit number each.

    The least ``ln a`` over the shingles depends on the chosen shingle and its step
    alone, so its bits name the sample.  Random variates come from fixed pools that
    the hash of a shingle points into.
    """
    best = np.full(SAMPLES, np.inf)
    log_w = np.log(weights.astype(np.float64))
    for start in range(0, len(hashes), 1024):
        mixed = hashes[start : start + 1024, None] * _FACTORS
        r = _R[(mixed >> np.uint64(52)).astype(np.intp)]
        beta = _BETA[(mixed >> np.uint64(40)).astype(np.intp) & (_POOL - 1)]
        log_c = _LOG_C[(mixed >> np.uint64(28)).astype(np.intp) & (_POOL - 1)]
        step = np.floor(log_w[start : start + 1024, None] / r + beta)
        np.minimum(best, (log_c - r * (step - beta + 1)).min(axis=0), out=best)
    return (_mixed(best.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def _bands(samples: np.ndarray) -> list[int]:
    rows = samples.reshape(BANDS, ROWS).astype(np.uint64)
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return mixed.view(np.int64).tolist()


def band_rows(texts: DataFrame, weights: _Weights) -> DataFrame:
    """``text_id, buckets`` for each row with a word."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, buckets = [], []
        for text_id, text in zip(batch.column("text_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            hashes, weight, flat = weights.of(text)
            if len(hashes):
                found = _bands(sample(hashes, weight))
                if flat is not None:
                    found += _bands(sample(hashes, flat))
                ids.append(text_id)
                buckets.append(list(dict.fromkeys(found)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))], names=["text_id", "buckets"]
        )

    return map_batches(texts.select("text_id", "text"), run, "text_id long, buckets array<long>")


_MEMBER = "bucket long, i int, j int, block int, text_id long, samples binary, flat binary, hashes binary, weights binary"


def _members(texts: DataFrame, weights: _Weights) -> DataFrame:
    """One row for each bucket (and pair of blocks) of a text, with its shingles."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text_id, text, buckets in zip(*[batch.column(c).to_pylist() for c in ("text_id", "text", "wanted")], strict=True):
            hashes, weight, flat = weights.of(text)
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            order = np.argsort(short, kind="stable")
            samples = sample(hashes, weight).tobytes()
            without = b"" if flat is None else sample(hashes, flat).tobytes()
            packed = (samples, without, short[order].tobytes(), weight[order].tobytes())
            for bucket in buckets:
                blocks = -(-bucket["size"] // BUCKET_TEXTS)
                own = text_id % blocks
                for other in range(blocks):
                    i, j = min(own, other), max(own, other)
                    rows.append((bucket["bucket"], i, j, own, text_id, *packed))
        columns = list(zip(*rows)) if rows else [()] * 9
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["bucket", "i", "j", "block", "text_id", "samples", "flat", "hashes", "weights"],
        )

    return map_batches(texts, run, _MEMBER, rows=64)


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], least: float = SIMILARITY) -> bool:
    """Whether weighted or plain Jaccard similarity of two shingle sets reaches ``least``."""
    _, x, y = np.intersect1d(a[0], b[0], return_indices=True)
    plain = len(x) / max(1, len(a[0]) + len(b[0]) - len(x))
    wa, wb = a[1].astype(np.float64), b[1].astype(np.float64)
    both = np.minimum(wa[x], wb[y]).sum()
    weighted = both / max(wa.sum() + wb.sum() - both, 1e-300)
    return weighted >= least or plain >= least


def bucket_links(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links that connect what is similar in a bucket, from its member rows.

    Rows are (i, j, block, text_id, samples, flat, hashes, weights); ``flat`` has the samples
    without counts and is empty where they are the same.  In a pair of different blocks
    only pairs across them are new, but links within are not repeated.
    """
    rows = list({row[3]: row for row in rows}.values())
    count = len(rows)
    kinds = [np.stack([np.frombuffer(row[4], np.uint32) for row in rows])]
    if any(row[5] for row in rows):
        kinds.append(np.stack([np.frombuffer(row[5] or row[4], np.uint32) for row in rows]))
    blocks = np.array([row[2] for row in rows])
    across = rows[0][0] != rows[0][1]
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    @functools.lru_cache(maxsize=4096)
    def body(x: int) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(rows[x][6], np.uint32), np.frombuffer(rows[x][7], np.float32)

    xs, ys, scores = [], [], []
    for start in range(0, count, 128):
        agree = np.zeros((min(128, count - start), count), np.int16)
        for samples in kinds:
            same = np.zeros_like(agree)
            for k in range(SAMPLES):
                same += samples[start : start + 128, k, None] == samples[None, :, k]
            np.maximum(agree, same, out=agree)
        near = agree >= LEAST_AGREEING
        near &= np.arange(count)[None, :] > np.arange(start, start + len(agree))[:, None]
        if across:
            near &= blocks[start : start + 128, None] != blocks[None, :]
        x, y = np.nonzero(near)
        xs.append(x + start)
        ys.append(y)
        scores.append(agree[x, y])
    x, y = np.concatenate(xs), np.concatenate(ys)
    links = []
    for at in np.argsort(-np.concatenate(scores), kind="stable"):
        p, q = int(x[at]), int(y[at])
        one, two = root(p), root(q)
        if one != two and similar(body(p), body(q)):
            parent[max(one, two)] = min(one, two)
            links.append((rows[p][3], rows[q][3]))
    return links


def _verify(members: DataFrame) -> DataFrame:
    importable_in_tasks(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[tuple]) -> pa.RecordBatch:
            links = bucket_links(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in links], pa.int64()), pa.array([q for _, q in links], pa.int64())], names=["a", "b"]
            )

        held, rows = None, []
        for batch in batches:
            for part in slices(batch, 256):
                for bucket, i, j, *rest in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if (bucket, i, j) != held and rows:
                        if len(rows) > 1:
                            yield solved(rows)
                        rows = []
                    held = (bucket, i, j)
                    rows.append((i, j, *rest))
        if len(rows) > 1:
            yield solved(rows)

    return members.mapInArrow(tidy(run), "a long, b long")


def similar_texts(texts: DataFrame) -> DataFrame:
    """Links ``a, b`` between text ids that connect all similar texts.

    ``texts`` has ``id``, ``text_id`` and ``text``.
    """
    spark = texts.sparkSession
    path = scratch_dir(spark, "near-duplicates")
    frequencies = document_frequencies(texts)
    weights = _Weights(spark.sparkContext.broadcast(rarity(frequencies, texts.count())))
    band_rows(texts, weights).write.parquet(f"{path}/bands")
    banded = spark.read.parquet(f"{path}/bands").select("text_id", F.explode("buckets").alias("bucket"))

    # Buckets of more than one text; copies of a text are one row per task here.
    (
        banded.groupBy("bucket")
        .agg(F.min("text_id").alias("low"), F.max("text_id").alias("high"))
        .filter("low <> high")
        .select("bucket")
        .write.parquet(f"{path}/shared")
    )
    shared = broadcast_if_small(spark.read.parquet(f"{path}/shared"), 24)
    banded.join(shared, "bucket", "left_semi").distinct().write.parquet(f"{path}/members")
    members = spark.read.parquet(f"{path}/members")
    # Of the buckets with the same members one is enough.
    (
        members.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("text_id")).alias("x"),
            F.bit_xor(F.xxhash64("text_id", F.lit(1))).alias("y"),
        )
        .groupBy("size", "x", "y")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "size")
        .write.parquet(f"{path}/chosen")
    )
    chosen = broadcast_if_small(spark.read.parquet(f"{path}/chosen"), 32)
    copies = texts.groupBy("text_id").agg(F.min("id").alias("wanted_id"))
    (
        members.join(chosen, "bucket")
        .groupBy(F.col("text_id").alias("wanted_text"))
        .agg(F.collect_list(F.struct("bucket", "size")).alias("wanted"))
        .join(copies, F.col("wanted_text") == F.col("text_id"))
        .drop("text_id")
        .write.parquet(f"{path}/wanted")
    )
    wanted = spark.read.parquet(f"{path}/wanted")
    wanted = F.broadcast(wanted) if fits(wanted, 64 + 64 * BANDS) else wanted
    one = (F.col("text_id") == F.col("wanted_text")) & F.col("id").eqNullSafe(F.col("wanted_id"))
    rows = _members(texts.join(wanted, one).select("text_id", "text", "wanted"), weights)
    together = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    _verify(together).write.parquet(f"{path}/links")
    return spark.read.parquet(f"{path}/links")


def _text_id(text: Column | str = "text") -> Column:
    return F.xxhash64(text_of(text))


def classes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, text_id, class_id``: one row per row; the class is its least id.

    Rows with equal texts are in one class, rows without words as well when their
    texts are equal.  Null reads as an empty text.  Similar are texts whose weighted
    (or plain) Jaccard similarity is 0.8 or more; classes are closed under that.
    Ids that are null name no class unless all of its ids are.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "classes")
    texts = docs.select(F.col(key).alias("id"), _text_id().alias("text_id"), text_of().alias("text"))
    labels = connected_components(similar_texts(texts))
    per_text = texts.groupBy("text_id").agg(F.min("id").alias("least"))
    labelled = per_text.join(labels, F.col("text_id") == F.col("node"), "left").select(
        "text_id", "least", F.coalesce("label", "text_id").alias("label")
    )
    labelled.write.parquet(path)
    labelled = spark.read.parquet(path)
    named = labelled.groupBy("label").agg(F.min("least").alias("class_id"))
    of_text = labelled.join(named, "label").select("text_id", "class_id")
    return texts.select("id", "text_id").join(of_text, "text_id").select(F.col("id").alias(key), "text_id", "class_id")


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one row left of each class, the one with its least id.

    Where rows repeat an id, or have none, the least text and one row of it stay.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "kept")
    found = classes(docs, key).select(F.col(key).alias("_id"), F.col("text_id").alias("_text"), "class_id")
    found.groupBy("_id", "_text", "class_id").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    best = (
        rows.filter(F.col("_id").eqNullSafe(F.col("class_id")))
        .groupBy("class_id")
        .agg(F.min("_text").alias("_best"))
        .withColumnRenamed("class_id", "_class")
    )
    joined = rows.join(best, F.col("class_id").eqNullSafe(F.col("_class")), "left")
    stays = F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_text") == F.col("_best"))
    joined.select("_id", "_text", stays.alias("stays"), "n").write.parquet(f"{path}/verdicts")
    verdicts = spark.read.parquet(f"{path}/verdicts")
    gone = broadcast_if_small(verdicts.filter("NOT stays").select("_id", "_text"), 48)
    left = rows_without(
        docs,
        gone,
        lambda doc: doc.getField(key).eqNullSafe(F.col("_id")) & (_text_id(doc.getField("text")) == F.col("_text")),
    )
    if verdicts.filter("stays AND n > 1").isEmpty():
        return left
    return left.dropDuplicates([key, "text"])
