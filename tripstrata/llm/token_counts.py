"""Token counts of whole texts, with a cache keyed by digests.

The cache is a table ``text_digest, tokenizer_digest, n_tokens``.  A run joins the
digests of its texts to it, encodes one text for each digest that is missing,
appends those counts, and joins again.  A second run over the same texts, or over
texts that differ in white space only, encodes nothing.

Texts are digested once into a staged table; only digests and ids take part in
aggregates.  Texts go through one shuffle, keyed by digest and row, so that a text
copied a million times does not meet in one task; just one of its copies finds a
partner there.  A digest that holds over a ten-thousandth of all rows gets its count
by broadcast; there are ten thousand of those at most.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm.common import held, map_batches, text_key, text_of
from tripstrata.sources.scratch import scratch_dir

LIMIT = 2048
MEMO_ENTRIES = 600_000
LEAST_COPIES, MOST_HOT = 1000, 10_000  # a hot digest has more copies; hot digests there can be
CACHE_SCHEMA = "text_digest binary, tokenizer_digest string, n_tokens long"

# Texts of these characters have one form only under NFC, and letters, numbers
# and white space in them are the same for every library.
_PLAIN = [0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x180)]
_PLAIN_TEXT = re.compile("[%s]*" % re.escape("".join(map(chr, _PLAIN))))


def _members(kind: str) -> str:
    return re.escape("".join(chr(c) for c in _PLAIN if unicodedata.category(chr(c))[0] == kind))


# Fixed by the vocabulary: the pieces that its merges never cross.
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\\s{L}{N}]+".format(L=_members("L"), N=_members("N"))
)


class Counter:
    """Counts tokens as the library does.

    A text of plain characters without special strings is normalised and split
    here, and its pieces are counted by the library once each.  Pieces are
    encoded apart from each other, so their counts add up.  Any other text goes
    through the library whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo: dict[str, int] = {}

    def _library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        split: list[list[str] | None] = []
        for text in texts:
            plain = _PLAIN_TEXT.fullmatch(text) and not any(s in text for s in self.special)
            # The library drops white space and lowers letters one by one.
            split.append(_PIECES.findall(text.lower()) if plain else None)
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        memo = self.memo
        missing = list({piece for pieces in split if pieces for piece in pieces if piece not in memo})
        memo.update(zip(missing, self._library(missing), strict=True))
        whole = iter(self._library([t for t, pieces in zip(texts, split, strict=True) if pieces is None]))
        return [next(whole) if p is None else sum(map(memo.__getitem__, p)) for p in split]


class _Definition:
    def __init__(self, digest: str, broadcast):
        self.digest, self.broadcast = digest, broadcast

    def __hash__(self):
        return hash(self.digest)

    def __eq__(self, other):
        return self.digest == other.digest


def _counter(definition: _Definition) -> Counter:
    return held(("counter", definition.digest), lambda: Counter(definition.broadcast.value))


def normal_digest(text: Column) -> Column:
    """Key of a text up to the white space that the tokenizer drops anyway."""
    return text_key(F.trim(F.regexp_replace(text, "[ \\t\\n\\r]+", " ")))


def read_cache(spark: SparkSession, path: str, tokenizer_digest: str) -> DataFrame:
    """One count per digest, however often it was appended; empty without a table."""
    try:
        table = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE_SCHEMA)
    ours = table.filter(F.col("tokenizer_digest") == tokenizer_digest)
    return ours.groupBy("text_digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str, key: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for each row; fills the cache on the way.

    Null reads as an empty text, which has no tokens.  Rows that repeat each get
    their row.  Special strings inside texts count as the library takes them by
    default, and nothing is cut or padded.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        body = file.read()
    version = hashlib.sha256(body.encode()).hexdigest()
    definition = _Definition(version, spark.sparkContext.broadcast(body))
    path = scratch_dir(spark, "text-digests")
    rows = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    text_digest = normal_digest(F.col("text")).alias("text_digest")
    rows.select("key", text_digest, F.octet_length("text").cast("long").alias("n_bytes")).write.parquet(f"{path}/rows")
    digests = spark.read.parquet(f"{path}/rows")

    copies = digests.groupBy("text_digest").agg(F.min(F.struct("key")).alias("one"), F.count(F.lit(1)).alias("n"))
    known = read_cache(spark, cache_path, version)
    missing = copies.join(known, "text_digest", "left_anti")
    chosen = missing.select(F.col("text_digest").alias("d"), F.col("one.key").alias("k"))
    # Rows stream past a hash table of the chosen ids; no sort of the texts.
    texts = rows.select("text", "key", text_digest).join(
        chosen.hint("shuffle_hash"),
        (F.col("text_digest") == F.col("d")) & F.col("key").eqNullSafe(F.col("k")),
        "left_semi",
    ).select("text_digest", "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counter(definition).count(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("text_digest"), pa.array([version] * len(counts)), pa.array(counts, pa.int64())],
            names=["text_digest", "tokenizer_digest", "n_tokens"],
        )

    map_batches(texts, count, CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    # Counts of hot digests go to the rows; all other rows go to their counts.
    hot = F.col("n") > max(LEAST_COPIES, digests.count() // MOST_HOT)
    copies.filter(hot).select("text_digest").join(
        read_cache(spark, cache_path, version), "text_digest"
    ).write.parquet(f"{path}/hot")
    counts_of_hot = F.broadcast(spark.read.parquet(f"{path}/hot"))
    rest = digests.join(counts_of_hot, "text_digest", "left_anti")
    counted = digests.join(counts_of_hot, "text_digest").unionByName(
        rest.join(read_cache(spark, cache_path, version), "text_digest")
    )
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
