r"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Each rule rejects a document whose measure lies above a cutoff.  Candidate cutoffs
form a fixed grid.  On labelled documents, per stratum, a cutoff counts as safe when
an exact binomial test refutes that it rejects more than ``risk / number of rules`` of
the good documents, at ``error / number of tests`` (every stratum, rule and cutoff is a
test).  So with confidence ``1 - error`` no stratum loses more than ``risk`` of its good
documents, over all its rules together.  Among safe cutoffs the one that rejects most
bad documents beyond good ones is taken, the laxest of equals.  A stratum with too
few labels to prove anything gets no cutoffs: its documents face the base rule only.

DataFrame functions throughout.  Measuring is a map over rows, staged once without
the texts.  The labels meet it in one join; counts are combined inside each task
before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import broadcast_if_small, text_of
from tripstrata.sources.scratch import scratch_dir

RISK = 0.03
ERROR = 0.05

# Fixed by the contract.
SPACE = r"[ \t\n\x0B\f\r]+"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

_SHARES = (0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9)
# Rule, its measure, and the cutoffs that may be chosen for it.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("try_divide(n_symbols, n_words)", (*_SHARES, 1.0, 2.0)),
    "capitals": ("n_capitals / greatest(word_chars, 1)", _SHARES),
    "repeated_lines": ("n_dup_lines / greatest(n_lines, 1)", _SHARES),
    "repeated_words": ("try_divide(n_repeat_words, n_words)", _SHARES),
    "long_words": ("try_divide(word_chars, n_words)", (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 40.0)),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_array(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _repeat_words(words: str, windows: str, ranked: str) -> Column:
    """Words inside windows that occur twice or more.

    ``ranked`` holds (hash, position) in order of hash: a window repeats when a
    neighbour has its hash.  Positions in order then each add the words that the
    one before has not covered.
    """
    at = F.sequence(F.lit(1), F.size(ranked))

    def h(j: Column) -> Column:
        return F.get(F.col(ranked), j).getField("h")

    repeated = F.filter(at, lambda j: (h(j - 2) == h(j - 1)) | (h(j) == h(j - 1)))
    places = F.array_sort(F.transform(repeated, lambda j: F.get(F.col(ranked), j - 1).getField("i")))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate(
        places,
        start,
        lambda a, p: F.struct(
            p.alias("last"),
            (a.getField("total") + F.least(F.lit(WINDOW), p - a.getField("last"))).alias("total"),
        ),
        lambda a: a.getField("total"),
    )
    return F.when(F.size(ranked) > 0, covered).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the measures of each row's whole text (null: none).

    Windows are told apart by a 64-bit hash within one text.
    """
    rows = docs.select(*[c.alias(name) for name, c in keep.items()], text_of().alias("_text"))
    rows = rows.withColumns(
        {
            "_words": words_array(F.col("_text")),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(NOT_SPACE)),
        }
    )
    many = F.size("_words") >= WINDOW
    starts = F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW)))
    rows = rows.withColumn("_windows", F.when(many, hashes).otherwise(F.array().cast("array<long>")))
    pairs = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    nothing = F.array().cast("array<struct<h:long,i:int>>")
    rows = rows.withColumn("_ranked", F.when(some, F.sort_array(pairs)).otherwise(nothing))
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_words", "_windows", "_ranked").alias("n_repeat_words"),
    )


def _log_gamma(x: Column) -> Column:
    """ln gamma for x of 1 or more, by Stirling's series at x + 7."""
    z = x + 7.0
    product = x
    for k in range(1, 7):
        product = product * (x + float(k))
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5))
    return (z - 0.5) * F.log(z) - z + F.lit(0.9189385332046727) + series - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p) where k < n p; 1 elsewhere, where no test passes.

    Sums down from the largest term.  Each term is the next one times a ratio that
    only falls, so terms further down than 40 deviations cannot be seen in a double.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = (
        _log_gamma(nd + 1)
        - _log_gamma(kd + 1)
        - _log_gamma(nd - kd + 1)
        + kd * F.log(F.lit(p))
        + (nd - kd) * F.log(F.lit(1 - p))
    )
    steps = F.least(kd, 50 + 40 * F.sqrt(nd * p)).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    sums = F.aggregate(
        F.sequence(F.lit(0), steps),
        start,
        lambda a, i: F.struct(
            (a.getField("term") * (kd - i) * (1 - p) / ((nd - kd + i + 1) * p)).alias("term"),
            (a.getField("sum") + a.getField("term")).alias("sum"),
        ),
        lambda a: a.getField("sum"),
    )
    return F.when(kd < nd * p, F.exp(top) * sums).otherwise(1.0)


def _value(rule: str) -> Column:
    return F.coalesce(F.expr(RULES[rule][0]), F.lit(0.0)).cast("double")


def _cutoffs_below(value: Column, cutoffs: tuple[float, ...]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda cutoff: value > cutoff))


def choose_cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, cutoffs`` (a map from rule to cutoff) from rows with measures and ``good``."""
    spark = labelled.sparkSession
    passed = [
        F.struct(F.lit(rule).alias("rule"), _cutoffs_below(_value(rule), cuts).alias("over"))
        for rule, (_, cuts) in RULES.items()
    ]
    counts = (
        labelled.select("stratum", "good", F.explode(F.array(*passed)).alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.over").alias("over"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    grid = spark.createDataFrame(
        [(rule, j, cut) for rule, (_, cuts) in RULES.items() for j, cut in enumerate(cuts)],
        "rule string, j int, cutoff double",
    )
    beyond = F.col("over") > F.col("j")
    tests = (
        counts.join(F.broadcast(grid), "rule")  # one row per candidate cutoff of the code above
        .groupBy("stratum", "rule", "cutoff")
        .agg(
            F.sum("good").alias("n"),
            F.sum(F.when(beyond, F.col("good")).otherwise(0)).alias("k"),
            F.sum(F.when(beyond, F.col("bad")).otherwise(0)).alias("caught"),
        )
    )
    n_tests = labelled.select("stratum").distinct().agg(F.count(F.lit(1)) * grid.count()).scalar()
    safe = binomial_tail(F.col("k"), F.col("n"), risk / len(RULES)) <= F.lit(error) / n_tests
    gain = F.col("caught") - F.col("k")
    return (
        tests.filter(safe & (gain > 0))
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct(gain, F.col("cutoff"))).alias("cutoff"))
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    stratum: str = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """``key``, the measures, ``base_failed`` and ``kept`` for each row.

    Labels that contradict each other count as bad; those without an id or a
    quality are left out.  A null stratum is a stratum of its own.  An empty or
    null text has no words and fails the base rule.
    """
    keep = {"key": F.col(key), "stratum": F.coalesce(F.col(stratum).cast("string"), F.lit(""))}
    path = scratch_dir(docs.sparkSession, "quality-measures")
    measure(docs, keep).write.parquet(path)
    measured = docs.sparkSession.read.parquet(path)
    known = (
        labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg((F.min("quality") > 0).alias("good"))
    )
    chosen = f"{path}-cutoffs"
    choose_cutoffs(measured.join(known, "key"), risk, error).write.parquet(chosen)
    cutoffs = docs.sparkSession.read.parquet(chosen)
    over = [_value(rule) > F.col("cutoffs").getItem(rule) for rule in RULES]
    rejected = F.lit(False)
    for one in over:
        rejected = rejected | F.coalesce(one, F.lit(False))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        measured.join(broadcast_if_small(cutoffs, 1024), "stratum", "left")
        .select(F.col("key").alias(key), *MEASURES, failed.alias("base_failed"), (~failed & ~rejected).alias("kept"))
    )
