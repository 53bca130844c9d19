r"""Secret scan with the ownership frequency of every candidate over the corpus.

Patterns find candidates in whole texts.  The digest of each candidate's value is
counted over the corpus by distinct repositories and owners.  A value held by many
owners is an example that people copy; one held by few is somebody's credential.
Long random-looking runs without a telling keyword are candidates too, and become
findings when they look live and are specific to an owner.

DataFrame functions throughout, no Python in tasks.  Positions come from splitting
the text by the pattern: the pieces between the matches and the matches themselves
have known lengths, and the work for a text grows in proportion to it and its matches.
Findings are staged once, without the texts.  A value that
fills a third of the corpus is combined inside each task before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.common import BROADCAST_BYTES, text_of
from tripstrata.sources.scratch import scratch_dir

# From this many owners on, a value counts as a widely copied example.
WIDE_OWNERS = 3
# A live-looking value has at least this many different characters.
LIVE_CHARACTERS = 8
BLOCK = 64  # entries of an array that are summed at once
PIECE = 64  # characters of a text that stay together while it is cut

# Fixed by the contract: kinds in their order, and their patterns.  A pattern with a
# least length finds the same runs as one that drops short matches, except for
# the first kind, whose short matches are dropped below.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
VALUE_LENGTH = 8
KINDS = ("assign", "access", "hex", "opaque")
# Added by the method: runs of 20 or more with digits, small and large letters.
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
PLACEHOLDERS = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|1234567"


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def _running(values: Column) -> Column:
    """The sum of an array of integers up to each entry.

    Appending copies the array so far, so sums run inside blocks, then over the
    blocks: the cost of an entry does not grow with the array.
    """
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))

    def add(a: Column, x: Column) -> Column:
        total = a.getField("sum") + x
        return F.struct(total.alias("sum"), F.array_append(a.getField("all"), total).alias("all"))

    def within(block: Column) -> Column:
        return F.aggregate(block, start, add, lambda a: a.getField("all"))

    def cut(every: Column) -> Column:
        last = F.floor((F.greatest(F.size(every), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: within(F.slice(every, i * BLOCK + 1, F.lit(BLOCK))))

    def shifted(blocks: Column) -> Column:
        upto = within(F.transform(blocks, lambda b: F.coalesce(_last(b), F.lit(0))))
        return F.flatten(F.zip_with(blocks, upto, lambda b, u: F.transform(b, lambda x: x + (u - _last(b)))))

    return _let(_let(values, cut), shifted)


def _matches(text: Column, pattern: str, kind: int, group: int) -> Column:
    """Array of (start, kind, end, value) of all matches, left to right."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        values.alias("value"),
    )
    # The last gap has no match after it.
    paired = F.filter(parts, lambda p: p.getField("size").isNotNull())

    def span(part: Column, end: Column) -> Column:
        begin = end - part.getField("size")
        return F.struct(
            begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part.getField("value").alias("value")
        )

    def spans(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: p.getField("gap") + p.getField("size")))
        return F.zip_with(parts, ends, span)

    return F.when(text.rlike(pattern), _let(paired, spans)).otherwise(F.array().cast(_SPAN))


def _looks_live(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(value, "")))
    return (different >= LIVE_CHARACTERS) & ~value.rlike(PLACEHOLDERS)


def candidates(text: Column) -> dict[str, Column]:
    """``base`` and ``extra``: arrays of (start, kind, end, value)."""
    assign = F.filter(_matches(text, ASSIGN, 0, 2), lambda s: F.length(s.getField("value")) >= VALUE_LENGTH)
    access = F.when(text.contains("AKIA"), _matches(text, ACCESS, 1, 0))
    base = F.concat(assign, F.coalesce(access, F.array().cast(_SPAN)), _matches(text, HEX, 2, 0))
    mixed = F.filter(
        _matches(text, OPAQUE, 3, 0),
        lambda s: s.getField("value").rlike("[0-9].*[0-9]")
        & s.getField("value").rlike("[a-z]")
        & s.getField("value").rlike("[A-Z]"),
    )
    return {"base": F.array_sort(base), "extra": mixed}


def _touched(spans: Column, e: Column) -> Column:
    """Whether a span touches one of those given, which are in order and do not overlap.

    The first that ends after the span begins is found by halving.
    """
    start = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halve(a: Column, _: Column) -> Column:
        low, high = a.getField("low"), a.getField("high")
        middle = F.shiftright(low + high, 1)
        before = (low < high) & (F.get(spans, middle).getField("end") <= e.getField("start"))
        return F.struct(
            F.when(before, middle + 1).otherwise(low).alias("low"),
            F.when(before, high).otherwise(middle).alias("high"),
        )

    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    first = F.get(spans, F.aggregate(halvings, start, halve, lambda a: a.getField("low")))
    return F.coalesce(first.getField("start") < e.getField("end"), F.lit(False))


def _apart(base: Column, extra: Column) -> Column:
    """Extra spans that touch no base span.  Base spans of one kind do not overlap."""

    def of_kind(kind: int) -> Column:
        return F.filter(base, lambda s: s.getField("kind") == kind)

    by_kind = F.array(*map(of_kind, range(3)))
    free = _let(by_kind, lambda kinds: F.filter(extra, lambda e: ~F.exists(kinds, lambda one: _touched(one, e))))
    return F.when((F.size(extra) > 0) & (F.size(base) > 0), free).otherwise(extra)


def stage_findings(docs: DataFrame, repository: Column, owner: Column, keep: list[str]) -> DataFrame:
    """Each row with its candidates, written once to the shared folder.

    ``_row`` numbers the rows of the written table, so later joins are by row and
    repeated ids do no harm.  The columns of the row itself are packed in ``_doc``,
    where their names cannot clash with others.
    """
    path = scratch_dir(docs.sparkSession, "secrets")
    spans = candidates(F.col("_text"))

    def digests(name: str) -> Column:
        return F.transform(
            name,
            lambda s: F.struct(
                s.getField("start").alias("start"),
                s.getField("kind").alias("kind"),
                s.getField("end").alias("end"),
                F.unhex(F.sha2(s.getField("value"), 256)).alias("digest"),
                _looks_live(s.getField("value")).alias("live"),
            ),
        )

    (
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_doc"),
            F.coalesce(repository.cast("string"), F.lit("")).alias("_repository"),
            F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"),
            text_of().alias("_text"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .withColumns(spans)
        .withColumn("extra", _apart(F.col("base"), F.col("extra")))
        .select("_doc", "_row", "_repository", "_owner", digests("base").alias("_base"), digests("extra").alias("_extra"))
        .write.parquet(path)
    )
    return docs.sparkSession.read.parquet(path)


def ownership(findings: DataFrame) -> DataFrame:
    """``digest, n_repositories, n_owners``: a repository is known by owner and name."""
    return (
        findings.select("digest", "_owner", "_repository")
        .distinct()
        .groupBy("digest", "_owner")
        .agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("digest")
        .agg(F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))
    )


def _judged(staged: DataFrame, wide_owners: int) -> DataFrame:
    """``_row, start, kind, end, wide, live``: the spans that stay.

    Extra candidates stay only when they look live and belong to few owners.
    """
    both = F.concat("_base", "_extra")
    findings = staged.filter(F.size(both) > 0).select("_row", "_repository", "_owner", F.inline(both))
    judged = findings.join(ownership(findings), "digest").withColumn("wide", F.col("n_owners") >= wide_owners)
    stays = (F.col("kind") < KINDS.index("opaque")) | (F.col("live") & ~F.col("wide"))
    return judged.filter(stays).select("_row", "start", "kind", "end", "wide", "live")


def judged_spans(staged: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``_row, judged``: spans (start, kind, end, wide, live) of each row that has some, in order."""
    span = F.struct("start", "kind", "end", "wide", "live")
    return _judged(staged, wide_owners).groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("judged"))


def _cuts(staged: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``_row, cuts``: per span (start, end, at, wide), where ``at`` ends the spans before it."""
    order = Window.partitionBy("_row").orderBy("start", "kind", "end")
    at = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.struct("start", "kind", "end", F.coalesce(at, F.lit(0)).alias("at"), "wide")
    spans = _judged(staged, wide_owners).select("_row", cut.alias("cut"))
    return spans.groupBy("_row").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    texts = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.get(names, s.getField("kind")), s.getField("start").cast("string"), s.getField("end").cast("string")
        ),
    )
    return F.array_join(texts, ",")


def _number_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s.getField("kind") == kind)).cast("long")


def scan_secrets(docs: DataFrame, repository: Column, owner: Column, key: str = "doc_id") -> DataFrame:
    """``key, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_shared`` per row.

    ``n_shared`` counts findings whose value many owners hold, ``n_live`` those that
    look live and that few hold.  A null text is empty and has no findings; a null
    repository or owner is one of its own.
    """
    staged = stage_findings(docs, repository, owner, [key])
    joined = staged.join(judged_spans(staged), "_row", "left")
    spans = F.coalesce("judged", F.array().cast("array<struct<start:int,kind:int,end:int,wide:boolean,live:boolean>>"))

    def counted(test) -> Column:
        return F.size(F.filter(spans, test)).cast("long")

    return joined.select(
        F.col("_doc").getField(key).alias(key),
        *[
            _number_of("_base", k).alias(f"n_{KINDS[k]}")
            for k in range(3)
        ],
        F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        counted(lambda s: s.getField("live") & ~s.getField("wide")).alias("n_live"),
        counted(lambda s: s.getField("wide")).alias("n_shared"),
    )


def _redacted(value: Column, cuts: Column) -> Column:
    """The text with a mark in place of every span; spans that overlap share a mark.

    A position is reached by counting characters from the start of a string, so the
    text is first cut into short pieces: the work grows with its length alone.
    """
    pieces = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        over = F.slice(pieces, first + 1, F.ceil(end / PIECE).cast("int") - first)
        return F.substr(F.array_join(over, ""), start % PIECE + 1, end - start)

    def marked(pieces: Column, s: Column) -> Column:
        at, start = s.getField("at"), s.getField("start")
        mark = F.when(s.getField("wide"), "<example-secret>").otherwise("<secret>")
        return F.when(start < at, "").otherwise(F.concat(between(pieces, at, F.greatest(start, at)), mark))

    def joined(pieces: Column) -> Column:
        end = F.greatest(_last(cuts).getField("at"), _last(cuts).getField("end"))
        parts = F.transform(cuts, lambda s: marked(pieces, s))
        return F.concat(F.array_join(parts, ""), between(pieces, end, F.length(value)))

    return _let(pieces, joined)


def redact_secrets(docs: DataFrame, repository: Column, owner: Column, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with every finding replaced by a mark of its class.

    Widely copied values become ``<example-secret>``, others ``<secret>``.  Rows
    without findings come back as they were; a null text stays null.
    """
    staged = stage_findings(docs, repository, owner, docs.columns)
    path = scratch_dir(docs.sparkSession, "secret-spans")
    _cuts(staged).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    # Counted, since a text may hold any number of spans.
    (spans, rows) = found.agg(F.coalesce(F.sum(F.size("cuts")), F.lit(0)), F.count(F.lit(1))).first()
    if spans * 64 + rows * 64 <= BROADCAST_BYTES:
        found = F.broadcast(found)
    value = F.col("_doc").getField(text)
    joined = staged.join(found, "_row", "left")
    return joined.select(
        *[
            F.when(F.col("cuts").isNotNull(), _redacted(value, F.col("cuts"))).otherwise(value).alias(c)
            if c == text
            else F.col("_doc").getField(c).alias(c)
            for c in docs.columns
        ]
    )
