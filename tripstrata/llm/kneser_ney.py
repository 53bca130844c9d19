"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model has order 3 over characters, with digits made alike and white space
folded.  It is trained on the trusted texts, those labelled good.  Counts are plain
aggregates; the tables of counts and contexts are joined, sharded by their keys, to
give a log probability to every trigram that the corpus contains, seen in training
or not.

Scoring joins those tables with the documents shard by shard.  A task packs its
documents into one block for each shard of trigrams: the distinct trigrams of the
block, and per document their numbers and counts, about a byte each once compressed.  Blocks meet the
probabilities of their shard, and only a partial sum per document leaves a shard.
Texts are never shuffled, and a text copied a million times is a million rows of
a sum that combines inside each task.

Thresholds are a stated quantile of the trusted documents of each language, exact over
log perplexities of seven decimals, so that repeated runs give the same verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.common import (
    broadcast_if_small,
    importable_in_tasks,
    rows_without,
    slices,
    text_key,
    text_of,
    tidy,
)
from tripstrata.sources.scratch import scratch_dir

SHARDS = 16
# Documents whose blocks of one shard meet in one task.
SLAB_DOCUMENTS = 400_000
BLOCK_DOCUMENTS = 1024
COUNT_DOCUMENTS = 256  # whose trigrams a task sorts at once
# Trusted documents that a language needs for thresholds of its own.
LEAST_TRUSTED = 30
# A limit is the HIGH quantile of trusted documents.  On held-out labels 0.98 rejects 4 %
# of the good documents where a language has few of them.
MIDDLE, HIGH = 0.5, 0.99
DECIMALS = 7  # of a log perplexity and of its distance from the middle

_BITS = 21  # of a code point
_MASK = (1 << _BITS) - 1
_START = 2  # stands before the first character


def characters(text: str) -> np.ndarray:
    """Code points with digits as 0 and each run of white space as one space."""
    codes = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((codes >= 48) & (codes <= 57), 48, codes)


def trigrams(text: str) -> np.ndarray:
    """One number per character: the two before it, then itself."""
    codes = np.concatenate([[_START, _START], characters(text)])
    return codes[:-2] << (2 * _BITS) | codes[1:-1] << _BITS | codes[2:]


def shard_of(grams: np.ndarray) -> np.ndarray:
    return ((grams >> (2 * _BITS)) * 31 + (grams >> _BITS & _MASK) * 7 + (grams & _MASK)) % SHARDS


def _parts(grams: DataFrame) -> DataFrame:
    """The three characters ``a``, ``b`` and ``c`` of the column ``gram``."""
    gram, mask = F.col("gram"), F.lit(_MASK)
    return grams.withColumns(
        {
            "a": F.shiftright(gram, 2 * _BITS),
            "b": F.shiftright(gram, _BITS).bitwiseAND(mask),
            "c": gram.bitwiseAND(mask),
        }
    )


def count_trigrams(texts: DataFrame) -> DataFrame:
    """``gram, n`` over all rows of a frame with the column ``text``."""
    importable_in_tasks(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, COUNT_DOCUMENTS):
                all_grams = [trigrams(t) for t in part.column("text").to_pylist()]
                grams, counts = np.unique(np.concatenate([np.empty(0, np.int64), *all_grams]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], names=["gram", "n"])

    return texts.mapInArrow(tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of a table of counts ``n``; one row of four numbers is fetched."""
    n1, n2, n3, n4 = counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    ratios = ((n1, n2), (n2, n3), (n3, n4))
    found = [k - (k + 1) * y * b / a if a and b else 0.5 * k for k, (a, b) in enumerate(ratios, 1)]
    return [min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found, 1)]


def _discount(n: Column, discounts: list[float]) -> Column:
    d1, d2, d3 = discounts
    return F.when(n >= 3, d3).when(n == 2, d2).when(n == 1, d1).otherwise(0.0)


def _contexts(counts: DataFrame, context: list[str], discounts: list[float], order: str) -> DataFrame:
    """Per context: the total of its counts and the mass that discounting frees."""
    return counts.groupBy(*context).agg(
        F.sum("n").alias(f"total{order}"), F.sum(_discount(F.col("n"), discounts)).alias(f"free{order}")
    )


def trigram_model(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram, logp`` for each wanted gram, from the training counts ``gram, n``."""
    three = _parts(counts)
    two = three.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n"))
    one = two.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    d3, d2, d1 = _discounts(three), _discounts(two), _discounts(one)
    # One row: how many contexts all characters follow, and how many there are.
    total, size, free = one.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(_discount(F.col("n"), d1)), F.lit(0.0))
    ).first()
    uniform = 1.0 / (size + 1)

    def kept(n: str, discounts: list[float]) -> Column:
        return F.coalesce(F.col(n) - _discount(F.col(n), discounts), F.lit(0.0))

    def interpolated(n: str, order: str, discounts: list[float], lower: Column) -> Column:
        seen = (kept(n, discounts) + F.col(f"free{order}") * lower) / F.col(f"total{order}")
        return F.coalesce(seen, lower)

    p1 = (kept("n1", d1) + F.lit(float(free) * uniform)) / float(total) if total else F.lit(uniform)
    p2 = interpolated("n2", "2", d2, p1)
    p3 = interpolated("n3", "3", d3, p2)
    return (
        _parts(wanted)
        .join(three.select("gram", F.col("n").alias("n3")), "gram", "left")
        .join(_contexts(three, ["a", "b"], d3, "3"), ["a", "b"], "left")
        .join(two.select("b", "c", F.col("n").alias("n2")), ["b", "c"], "left")
        .join(_contexts(two, ["b"], d2, "2"), "b", "left")
        .join(one.select("c", F.col("n").alias("n1")), "c", "left")
        .select("gram", F.log(p3).alias("logp"))
    )


_BLOCK = "shard int, slab int, keys binary, docs binary, grams binary, index binary, counts binary"


def pack(texts: DataFrame) -> DataFrame:
    """Blocks of documents by shard, from rows ``key`` (16 bytes), ``slab`` and ``text``.

    Per block: keys of its documents; for every entry the document, the number of the
    trigram in ``grams``, and how often it occurs (long counts are split up).
    """
    importable_in_tasks(texts.sparkSession)

    def blocks(part: pa.RecordBatch) -> pa.RecordBatch:
        keys = b"".join(part.column("key").to_pylist())
        found = [np.unique(trigrams(t), return_counts=True) for t in part.column("text").to_pylist()]
        docs = np.repeat(np.arange(len(found), dtype=np.int32), [len(g) for g, _ in found])
        grams = np.concatenate([np.empty(0, np.int64), *[g for g, _ in found]])
        counts = np.concatenate([np.empty(0, np.int64), *[n for _, n in found]]).astype(np.int32)
        found = [None] * len(found)
        times = np.maximum(1, -(-counts // 255))
        if len(times) and times.max() > 1:
            docs, grams, left = (np.repeat(x, times) for x in (docs, grams, counts))
            step = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
            counts = np.minimum(255, left - 255 * step)
        shards = shard_of(grams).astype(np.uint8)
        order = np.argsort(shards, kind="stable")  # documents stay in order
        docs, grams, counts, shards = docs[order], grams[order], counts[order], shards[order]
        cuts = np.searchsorted(shards, np.arange(SHARDS + 1))
        rows = []
        for shard in range(SHARDS):
            at = slice(cuts[shard], cuts[shard + 1])
            if at.start == at.stop:
                continue
            distinct, index = np.unique(grams[at], return_inverse=True)
            per_doc = np.bincount(docs[at], minlength=len(found)).astype("<u4")
            # Numbers rise within a document; their steps are small, and compress
            # well when bytes of the same weight stand together.
            step = np.diff(index, prepend=0)
            first = np.concatenate([[True], docs[at][1:] != docs[at][:-1]])
            step = np.where(first, index, step).astype("<u2" if len(distinct) < 65536 else "<u4")
            planes = step.view("u1").reshape(len(step), -1).T
            rows.append(
                (
                    shard,
                    keys,
                    per_doc.tobytes(),
                    distinct.astype("<i8").tobytes(),
                    planes.tobytes(),
                    counts[at].astype("u1").tobytes(),
                )
            )
        columns = list(zip(*rows)) if rows else [()] * 6
        slab = part.column("slab")[0].as_py() if part.num_rows else 0
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array([slab] * len(rows), pa.int32())]
            + [pa.array(c, pa.binary()) for c in columns[1:]],
            names=["shard", "slab", "keys", "docs", "grams", "index", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BLOCK_DOCUMENTS):
                yield blocks(part)

    return texts.mapInArrow(tidy(run), _BLOCK)


def _score(blocks: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    order = np.argsort(model["gram"].to_numpy())
    grams, logp = model["gram"].to_numpy()[order], model["logp"].to_numpy()[order]
    out = []
    for block in blocks.itertuples(index=False):
        keys = [block.keys[i : i + 16] for i in range(0, len(block.keys), 16)]
        distinct = np.frombuffer(block.grams, "<i8")
        counts = np.frombuffer(block.counts, "u1").astype(np.float64)
        planes = np.frombuffer(block.index, "u1").reshape(-1, len(counts))
        step = np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel()
        per_doc = np.frombuffer(block.docs, "<u4").astype(np.int64)
        docs = np.repeat(np.arange(len(keys)), per_doc)
        sums = np.cumsum(step, dtype=np.int64)
        starts = np.cumsum(per_doc) - per_doc
        head = np.where(starts > 0, sums[np.maximum(starts, 1) - 1], 0)
        values = logp[np.searchsorted(grams, distinct)][sums - head[docs]]
        sums = np.bincount(docs, values * counts, len(keys))
        sizes = np.bincount(docs, counts, len(keys))
        out.append(pd.DataFrame({"key": keys, "logp": sums, "n": sizes})[sizes > 0])
    return pd.concat(out) if out else pd.DataFrame({"key": [], "logp": [], "n": []})


def perplexities(docs: DataFrame, trusted: DataFrame, key: str = "doc_id") -> DataFrame:
    """``text_key, log_perplexity`` for each distinct text that has a character.

    ``trusted`` holds the ids (column ``key``) of the rows to train on.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "language-model")
    trusted.select("key").distinct().write.parquet(f"{path}/trusted")
    ids = spark.read.parquet(f"{path}/trusted")
    rows = docs.select(F.col(key).alias("id"), text_of().alias("text"))
    training = rows.join(broadcast_if_small(ids, 64), rows["id"] == ids["key"], "left_semi")
    count_trigrams(training.select("text")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")

    # Every trigram of the corpus gets a probability, in training or not.
    wanted = count_trigrams(rows.select("text")).select("gram")
    trigram_model(counts, wanted).write.parquet(f"{path}/model")
    model = spark.read.parquet(f"{path}/model")

    slabs = max(1, -(-docs.count() // SLAB_DOCUMENTS))
    slab = F.pmod(F.spark_partition_id(), F.lit(slabs)).cast("int").alias("slab")
    blocks = pack(rows.select(text_key(F.col("text")).alias("key"), slab, "text"))
    shard = F.expr(f"CAST((a * 31 + b * 7 + c) % {SHARDS} AS INT)")
    per_slab = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab")
    sharded = _parts(model).select("gram", "logp", shard.alias("shard"), per_slab)
    return (
        blocks.groupBy("shard", "slab")
        .cogroup(sharded.groupBy("shard", "slab"))
        .applyInPandas(_score, "key binary, logp double, n double")
        # Copies of a text add to both sums alike.
        .groupBy(F.col("key").alias("text_key"))
        .agg((-F.sum("logp") / F.sum("n")).alias("log_perplexity"))
    )


def nearest_ranks(values: DataFrame, probabilities: list[float], width: float) -> DataFrame:
    """``lang, p, v, total``: exact quantiles of ``v`` per language, and of all rows as null.

    Equal values collapse inside tasks.  Cells of the given width find where a rank
    lies, then the values of that cell alone are ordered, so no window sees more
    than the cells of a language or the values of one cell.
    """
    counts = values.groupBy(F.concat(F.lit("="), "lang").alias("group"), "v").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy(F.lit("").alias("group"), "v").agg(F.sum("n").alias("n"))
    celled = counts.unionByName(whole).withColumn("cell", F.floor(F.col("v") / width))
    group = Window.partitionBy("group")
    cells = celled.groupBy("group", "cell").agg(F.sum("n").alias("n")).withColumns(
        {"upto": F.sum("n").over(group.orderBy("cell")), "total": F.sum("n").over(group)}
    )
    rank = F.greatest(F.ceil(F.col("p") * F.col("total")), F.lit(1))
    sought = cells.withColumn("p", F.explode(F.array(*map(F.lit, probabilities)))).filter(
        (rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n"))
    )
    sought = sought.select("group", "cell", "p", "total", (rank - F.col("upto") + F.col("n")).alias("rank"))
    inside = celled.join(sought, ["group", "cell"]).withColumn(
        "upto", F.sum("n").over(Window.partitionBy("group", "p").orderBy("v"))
    )
    found = inside.filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
    lang = F.when(F.col("group") != "", F.substring("group", 2, 1 << 30))
    return found.select(lang.alias("lang"), "p", "v", "total")


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", language: str = "lang"
) -> DataFrame:
    """``key, lang, text_key, perplexity, threshold, kept``, one row for each row of ``docs``.

    Trusted are the ids whose labels all say good.  Two limits are the HIGH quantiles of
    the trusted documents of a language, one on the log perplexity and one on its
    distance from the middle in standard errors of a text of that length; a text is
    rejected beyond both.  A language without enough trusted documents takes the
    limits over all languages; without any trusted document every text is kept.  A text without
    characters has no perplexity and is rejected.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "perplexity")
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    known.agg((F.min("quality") > 0).alias("good")).filter("good").select("key").write.parquet(f"{path}/trusted")
    trusted = spark.read.parquet(f"{path}/trusted")
    scores = perplexities(docs, trusted, key)
    lang = F.coalesce(F.col(language).cast("string"), F.lit("")).alias("lang")
    text = text_of()
    rows = docs.select(
        F.col(key).alias("key"), lang, text_key(text).alias("text_key"), F.greatest(F.length(text), F.lit(1)).alias("size")
    )
    # Rounded, so that the order in which tasks add up cannot sway a verdict.
    score = F.round("log_perplexity", DECIMALS)
    rows.join(scores, "text_key", "left").withColumn("log_perplexity", score).write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")
    held = scored.join(broadcast_if_small(trusted, 64), "key", "left_semi").filter("log_perplexity IS NOT NULL")

    def limits(value: Column, frame: DataFrame, name: str, width: float) -> None:
        """Write middle and limit of a value per language, and over all of them as null."""
        found = nearest_ranks(frame.select("lang", value.alias("v")), [MIDDLE, HIGH], width)
        both = found.groupBy("lang").agg(
            F.max(F.when(F.col("p") == MIDDLE, F.col("v"))).alias(f"{name}_middle"),
            F.max(F.when(F.col("p") == HIGH, F.col("v"))).alias(f"{name}_limit"),
            F.max("total").alias("n"),
        )
        enough = F.col("lang").isNull() | (F.col("n") >= LEAST_TRUSTED)
        both.filter(enough).drop("n").write.parquet(f"{path}/{name}")

    def limited(frame: DataFrame, name: str) -> DataFrame:
        """The rows with the middle and the limit of their language."""
        table = spark.read.parquet(f"{path}/{name}")
        general = table.filter("lang IS NULL").select(F.struct(f"{name}_middle", f"{name}_limit")).scalar()
        joined = frame.join(broadcast_if_small(table.filter("lang IS NOT NULL"), 256), "lang", "left")
        both = [f"{name}_middle", f"{name}_limit"]
        return joined.withColumns({c: F.coalesce(c, general.getField(c)) for c in both})

    limits(F.col("log_perplexity"), held, "level", 1 / 1024)
    # Short texts stray further: their distance from the middle counts in standard errors.
    errors = F.round((F.col("log_perplexity") - F.col("level_middle")) * F.sqrt("size"), DECIMALS)
    limits(errors, limited(held, "level"), "error", 1 / 16)
    judged = limited(limited(scored, "level"), "error")
    threshold = F.greatest("level_limit", F.col("level_middle") + F.col("error_limit") / F.sqrt("size"))
    kept = F.coalesce(F.col("log_perplexity") <= threshold, F.col("log_perplexity").isNotNull())
    return judged.select(
        F.col("key").alias(key),
        "lang",
        "text_key",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(threshold).alias("threshold"),
        kept.alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", language: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, unchanged.

    Rejected texts are looked up by digest and language; their list is broadcast
    when its counted size allows, else joined by shuffle.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "rejected")
    verdicts = classify(docs, labels, key, language)
    verdicts.filter(~F.col("kept")).select(F.col("lang").alias("_l"), F.col("text_key").alias("_k")).distinct().write.parquet(path)
    rejected = broadcast_if_small(spark.read.parquet(path), 128)
    return rows_without(
        docs,
        rejected,
        lambda doc: (text_of(doc.getField(language)) == F.col("_l"))
        & (text_key(text_of(doc.getField("text"))) == F.col("_k")),
    )
