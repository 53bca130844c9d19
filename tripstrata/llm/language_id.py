"""Language of web pages by fusing evidence from text, markup and address.

    posterior(l)  ~  P(text | l) ^ t  *  P(declared | l)  *  P(suffix | l)  *  P(path | l)  *  prior(l | host)

* P(text | l): a naive Bayes model over hashed character trigrams, counted over all
  labelled documents by grouped aggregation.  Its table is languages times 2^15
  cells, so it has a fixed size; it is broadcast to the tasks that read pages.
* P(declared | l), P(suffix | l) and P(path | l): how often pages of a language
  declare a markup language, have an address suffix, or name a code in their path.
  These come from sums of text posteriors over all pages.
* prior(l | host): the sums of a host are smoothed by those of its domain, these by
  those of its suffix, and these by the whole corpus.  A page's own share is taken
  off first, so that it does not confirm itself.

Pages are read once; what follows works on a staged row of numbers for each page.
Sums combine inside tasks first, so a host with a third of all pages shuffles one row
per task; its pages then meet their host's row in a join that adaptive execution splits.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import importable_in_tasks, map_batches, slices, text_of, tidy
from tripstrata.sources.scratch import scratch_dir

CELLS = 1 << 15
BLOCK = 256  # languages whose part of the model a Python worker holds at once: 32 MiB
HELD = 64  # languages that a task counts side by side
# Fixed by the standard: a tag begins with a code of two or three letters.
TAG = r"^\s*([A-Za-z]{2,3})(?:[-_][A-Za-z0-9_-]*)?\s*$"
SMOOTH = 0.5  # added to every trigram cell
TEMPER = 0.25  # trigrams overlap, so the text counts for less than their product
STRENGTH = 5.0  # pages that a level of the hierarchy is worth to the one below
NOISE = 0.5  # added to every cell of a piece of evidence

_DROPPED = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>")
# Comments and code, which may hold tags that are none, and html tags.
_CODE_OR_HTML = re.compile(
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|noscript|template)(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"|<html(?=[\s/])(?P<attributes>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*)"
)
_LANG = re.compile(r"(?is)(?<![\w:-])(?:xml:)?lang\s*=\s*[\"']?\s*([a-z]{2,3})|=\s*(?:\"[^\"]*\"|'[^']*')")
_ADDRESS = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)[^/?#]*(/[^?#]*)?")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def declared_language(page: str) -> str:
    """Language of the first html tag that declares one, wherever it stands, else an empty string."""
    for tag in _CODE_OR_HTML.finditer(page):
        for found in _LANG.finditer(tag["attributes"] or ""):
            if found[1]:
                return found[1].lower()
    return ""


def visible_text(page: str) -> str:
    return html.unescape(_DROPPED.sub(" ", page))


def trigram_cells(text: str) -> np.ndarray:
    """Cells of the character trigrams of lower-case words."""
    codes = np.frombuffer(f" {_NOT_LETTERS.sub(' ', text.lower())} ".encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) < 3:
        return np.empty(0, np.int64)
    codes = codes.astype(np.uint64)
    mixed = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA6B) + codes[2:] * np.uint64(0xC2B2AE35)
    return ((mixed ^ (mixed >> np.uint64(15))) % np.uint64(CELLS)).astype(np.int64)


def train(docs: DataFrame, language: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and the log likelihood of each cell under each of them.

    A language is the first code of its tag, in small letters: ``en`` for ``EN-us``.  Rows
    with another kind of tag, or none, are left out.  Counts cover all labelled rows.
    The languages are as many as there are codes, some hundreds in practice.
    """
    tag = F.lower(F.regexp_extract(F.col(language).cast("string"), TAG, 1))
    labelled = docs.select(tag.alias("lang"), text_of().alias("text")).filter("lang <> ''")
    importable_in_tasks(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def counted() -> pa.RecordBatch:
            names = list(sums)
            blobs = [sums[n].tobytes() for n in names]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(blobs, pa.binary())], names=["lang", "cells"])

        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if lang not in sums and len(sums) >= HELD:
                        yield counted()
                    own = sums.setdefault(lang, np.zeros(CELLS, np.int64))
                    own += np.bincount(trigram_cells(text), minlength=CELLS)
        yield counted()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, 16):
                for lang, blob in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if held is not None and lang != held:
                        yield summed_row(held, total)
                        total = np.zeros(CELLS, np.int64)
                    held = lang
                    total += np.frombuffer(blob, np.int64)
        if held is not None:
            yield summed_row(held, total)

    def summed_row(lang: str, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tobytes()], pa.binary())], names=["lang", "cells"])

    schema = "lang string, cells binary"
    counted = labelled.mapInArrow(tidy(count), schema)
    summed = counted.repartition("lang").sortWithinPartitions("lang").mapInArrow(tidy(add), schema)
    # One row of fixed size for each language.
    found = {row.lang: np.frombuffer(row.cells, np.int64) for row in summed.collect()}
    languages = sorted(found)
    logs = np.empty((len(languages), CELLS), np.float32)
    for number, lang in enumerate(languages):
        counts = found.pop(lang) + SMOOTH
        logs[number] = np.log(counts / counts.sum())
    return languages, logs


class _Model:
    def __init__(self, broadcast):
        self.name, self.broadcast = uuid4().hex, broadcast


_PAGE = (
    "key {kind}, host string, domain string, suffix string, path string, declared string, "
    "text_logp array<double>, text_share array<double>"
)


def address_parts(url: str) -> tuple[str, str, str, str]:
    """Host, domain (its last two labels), suffix (its last one) and first code in the path."""
    found = _ADDRESS.match(url.strip())
    host = (found[1] if found else "").lower().strip(".")
    labels = host.split(".")
    path = (found[2] or "") if found else ""
    code = next((p.lower() for p in path.split("/") if re.fullmatch(r"[A-Za-z]{2}", p)), "")
    return host, ".".join(labels[-2:]), labels[-1], code


def read_pages(pages: DataFrame, models: list[_Model], key: str, url: str, page: str) -> DataFrame:
    """A row of evidence for each page; null columns read as empty ones.

    Each block of languages scores the texts in a pass of its own, so no worker holds more
    than one block of the model.  The last pass adds the other evidence.
    """
    kind = pages.schema[key].dataType.simpleString()

    def likelihoods(model: _Model, batch: pa.RecordBatch) -> list[np.ndarray]:
        logs, before = model.broadcast.value, batch.column("logp").to_pylist()
        bodies = batch.column("body").to_pylist()
        own = [logs[:, trigram_cells(visible_text(body))].sum(axis=1, dtype=np.float64) * TEMPER for body in bodies]
        return [np.concatenate([a or [], b]) for a, b in zip(before, own, strict=True)]

    def score(batch: pa.RecordBatch, model: _Model) -> pa.RecordBatch:
        logp = pa.array([x.tolist() for x in likelihoods(model, batch)], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns[:3], logp], names=["key", "url", "body", "logp"])

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        scored = likelihoods(models[-1], batch)
        for address, body, logp in zip(batch.column("url").to_pylist(), batch.column("body").to_pylist(), scored, strict=True):
            share = np.exp(logp - logp.max())
            rows.append((*address_parts(address), declared_language(body), logp.tolist(), (share / share.sum()).tolist()))
        columns = list(zip(*rows)) if rows else [()] * 7
        types = [*[pa.string()] * 5, pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
            names=["key", "host", "domain", "suffix", "path", "declared", "text_logp", "text_share"],
        )

    rows = pages.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(page).cast("string"), F.lit("")).alias("body"),
        F.lit(None).cast("array<double>").alias("logp"),
    )
    for model in models[:-1]:
        rows = map_batches(
            rows, functools.partial(score, model=model), f"key {kind}, url string, body string, logp array<double>", rows=128
        )
    return map_batches(rows, finish, _PAGE.format(kind=kind), rows=128)


def _sums(rows: DataFrame, by: list[str], name: str, size: int) -> DataFrame:
    """Sum of text shares per language, for each value of the columns."""
    return rows.groupBy(*by).agg(F.array(*[F.sum(F.get("text_share", F.lit(i))) for i in range(size)]).alias(name))


def _zip(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, f)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _smoothed(counts: Column, above: Column) -> Column:
    """Shares of the counts, with those above worth STRENGTH pages."""
    total = _total(counts) + STRENGTH
    return _zip(counts, above, lambda n, p: (n + STRENGTH * p) / total)


def identify(
    pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", language: str = "lang",
    block: int = BLOCK,
) -> DataFrame:
    """``key, lang, confidence, text_lang, declared, host`` for each page.

    Ties go to the first language in order.  A page without text is judged by its
    other evidence; one without any falls to the prior.  Without a labelled
    document there are no languages, and ``lang`` is null.  Pages that repeat are
    judged each.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "language-id")
    languages, logs = train(docs, language)
    size = len(languages)
    if not size:
        nothing = {"lang": "string", "confidence": "double", "text_lang": "string", "declared": "string", "host": "string"}
        return pages.select(key, *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    blocks = [logs[n : n + block] for n in range(0, size, block)]
    models = [_Model(spark.sparkContext.broadcast(part)) for part in blocks]
    read_pages(pages, models, key, url, page).write.parquet(f"{path}/pages")
    rows = spark.read.parquet(f"{path}/pages")

    # Sums by host, then up the hierarchy from the sums below.
    _sums(rows, ["host", "domain", "suffix"], "by_host", size).write.parquet(f"{path}/hosts")
    hosts = spark.read.parquet(f"{path}/hosts")

    def rolled(by: str, name: str) -> DataFrame:
        return hosts.groupBy(by).agg(F.array(*[F.sum(F.get("by_host", F.lit(i))) for i in range(size)]).alias(name))

    whole = hosts.agg(F.array(*[F.coalesce(F.sum(F.get("by_host", F.lit(i))), F.lit(0.0)) for i in range(size)])).scalar()
    even = F.array_repeat(F.lit(1.0 / size), size)
    hierarchy = (
        hosts.join(rolled("domain", "by_domain"), "domain")
        .join(rolled("suffix", "by_suffix"), "suffix")
        .withColumn("by_all", whole)
    )
    hierarchy.write.parquet(f"{path}/hierarchy")
    hierarchy = spark.read.parquet(f"{path}/hierarchy")

    def evidence(column: str) -> DataFrame:
        """ln P(value | l) for each value of a column."""
        counts = _sums(rows, [column], "n", size)
        counts = counts.withColumns({"_whole": whole, "_values": counts.agg(F.count(F.lit(1))).scalar()})
        given = F.zip_with("n", "_whole", lambda n, total: F.log((n + NOISE) / (total + NOISE * F.col("_values"))))
        return counts.select(F.col(column), given.alias(f"logp_{column}"))

    def less_own(counts: str) -> Column:
        return _zip(F.col(counts), F.col("text_share"), lambda n, own: F.greatest(n - own, F.lit(0.0)))

    prior = even
    for level in ("by_all", "by_suffix", "by_domain", "by_host"):
        prior = _smoothed(less_own(level), prior)
    # Values without content are no evidence.
    fused = F.col("text_logp")
    joined = rows.join(hierarchy, ["host", "domain", "suffix"])
    for column in ("declared", "suffix", "path"):
        joined = joined.join(evidence(column), column)
        known = F.when(F.col(column) != "", F.col(f"logp_{column}")).otherwise(F.array_repeat(F.lit(0.0), size))
        fused = _zip(fused, known, lambda a, b: a + b)
    joined = joined.withColumn("prior", prior)
    scored = joined.withColumn("score", _zip(fused, F.col("prior"), lambda a, p: a + F.log(p)))
    best = F.array_max("score")
    names = F.array(*map(F.lit, languages))
    weight = _total(F.transform("score", lambda x: F.exp(x - best)))
    return scored.select(
        F.col("key").alias(key),
        F.get(names, (F.array_position("score", best) - 1).cast("int")).alias("lang"),
        (1 / weight).alias("confidence"),
        F.get(names, (F.array_position("text_share", F.array_max("text_share")) - 1).cast("int")).alias("text_lang"),
        "declared",
        "host",
    )
