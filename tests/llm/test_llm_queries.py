"""The registered text queries against plain Python or SQL over whole small tables."""

import math

import brute
import duckdb
import pytest
from oracle_compare import connect, differences

import corpus_pipeline
from tripstrata.llm import kneser_ney
from tripstrata.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()


def rows_by_id(frame, *columns):
    found = {row[0]: tuple(row[1:]) for row in frame.select("doc_id", *columns).collect()}
    return found


def query(spark, name):
    return QUERIES[next(k for k in QUERIES if k.startswith(name))](spark, SF_DIR)


def test_secrets(spark, docs):
    found = query(spark, "op1_")
    ours = rows_by_id(found, "n_assign", "n_access", "n_hex", "base_sha256")
    assert ours == {d[0]: brute.secrets(d[1]) for d in docs}
    for row in found.select("n_assign", "n_access", "n_hex", "spans").collect():
        kinds = [s.split(":")[0] for s in row.spans.split(",") if s]
        assert [kinds.count(k) for k in ("assign", "access", "hex")] == [row.n_assign, row.n_access, row.n_hex]


def test_near_duplicates(spark, docs):
    assert rows_by_id(query(spark, "op2_"), "class_id") == {
        k: (c,) for k, c in brute.near_classes([d[:2] for d in docs]).items()
    }


def test_quality_classifier(spark, docs):
    found = {r.doc_id: r for r in query(spark, "op3_").collect()}
    good = {k for k, q in duckdb.sql(f"SELECT doc_id, min(quality) FROM '{SF_DIR}/labels.parquet' GROUP BY 1").fetchall() if q}
    logs = brute.kneser_ney([d[1] for d in docs if d[0] in good], [d[1] for d in docs])
    for (key, *_), log in zip(docs, logs, strict=True):
        assert found[key].perplexity == pytest.approx(math.exp(log), rel=1e-6)
        assert found[key].kept == (found[key].perplexity <= found[key].threshold)
    assert len(found) == len(docs)


def test_quality_classifier_tells_good_from_bad(spark):
    """On documents that it was not trained on: those with an odd id are not trusted."""
    larger = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    found = kneser_ney.classify(docs, labels.filter("doc_id % 2 = 0"))
    held_out = found.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    bad, good = ([r.kept for r in held_out if r.quality == q] for q in (0, 1))
    assert bad.count(False) >= 0.7 * len(bad) and good.count(True) >= 0.98 * len(good)


def test_quality_limits_are_the_stated_quantile(spark):
    """The limit of a long text is the quantile of the trusted ones of its language, and no more."""
    larger = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality")
    rows = kneser_ney.classify(spark.read.parquet(f"{larger}/documents.parquet"), labels).collect()
    bad = {r.doc_id for r in labels.collect() if not r.quality}
    good = {r.doc_id for r in labels.collect()} - bad
    own = sorted(r.perplexity for r in rows if r.lang == "en" and r.doc_id in good)
    limit = min(r.threshold for r in rows if r.lang == "en")
    assert limit == pytest.approx(own[math.ceil(kneser_ney.HIGH * len(own)) - 1], rel=1e-9)


def test_benchmark_windows(spark, docs, items):
    owners = brute.windows(items)
    ours = rows_by_id(query(spark, "op4_"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert ours == {d[0]: brute.contamination(d[1], owners) for d in docs}
    assert any(r[4] for r in ours.values())


def test_token_counts(spark, docs):
    counts = brute.token_counts([d[1] or "" for d in docs])
    ours = rows_by_id(query(spark, "op5_"), "n_bytes", "n_tokens", "over_limit")
    assert ours == {d[0]: (len((d[1] or "").encode()), n, n > 2048) for d, n in zip(docs, counts, strict=True)}


def test_page_languages(spark):
    """Paths of the pages name their language; the evidence agrees with it."""
    found = query(spark, "op6_").collect()
    paths = dict(duckdb.sql(f"SELECT page_id, regexp_extract(url, '/([a-z][a-z])/', 1) FROM '{SF_DIR}/pages.parquet'").fetchall())
    assert len(found) == len(paths)
    named = [r for r in found if paths[r.page_id] in ("de", "en", "es", "fr")]
    assert sum(r.lang == paths[r.page_id] for r in named) >= 0.95 * len(named)


def test_quality_rules(spark, docs):
    found = query(spark, "op7_")
    ours = rows_by_id(found, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert ours == {d[0]: brute.measures(d[1]) for d in docs}
    assert found.filter("base_failed AND kept").isEmpty()


@pytest.mark.parametrize("name", ORACLE)
def test_queries_match_sql(spark, name):
    con = connect(SF_DIR)
    assert differences(spark, con, QUERIES[name], ORACLE[name], SF_DIR) == []


def test_repeats(spark, docs):
    ours = rows_by_id(query(spark, "op9_"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert ours == dict(zip([d[0] for d in docs], brute.repeats([d[1] for d in docs]), strict=True))


def test_byte_bpe(spark, docs):
    library = brute.bpe_library()
    ours = rows_by_id(query(spark, "op10_"), "n_tokens", "ids_sha256", "decoded_sha256")
    assert ours == {d[0]: brute.bpe_row(library, d[1]) for d in docs}


def test_pipeline(spark, docs, items):
    """Stage by stage in plain Python, with the verdicts of the classifier as given."""
    kept = {r.doc_id for r in query(spark, "op3_").filter("kept").collect()}
    left = [d for d in docs if d[0] in kept]
    firsts = brute.near_classes([d[:2] for d in left])
    left = [d for d in left if firsts[d[0]] == d[0]]
    owners = brute.windows(items)
    left = [d for d in left if not brute.contamination(d[1], owners)[4]]
    found = {r[0]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(found) == {d[0] for d in left}
    library = brute.bpe_library()
    clean = [d for d in left if brute.secrets(d[1])[:3] == (0, 0, 0)]
    assert len(clean) > 100
    for d in clean:
        assert (found[d[0]].n_tokens, found[d[0]].ids_sha256, found[d[0]].decoded_sha256) == brute.bpe_row(library, d[1])
    for d in left:
        if d not in clean:
            text = library.decode(list(memoryview(bytes(found[d[0]].ids)).cast("I")))
            assert brute.secrets(text)[:3] == (0, 0, 0) and "<secret>" in text


def test_page_languages_by_the_stated_formula(spark):
    labelled = duckdb.sql(f"SELECT lang, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    expected = brute.page_languages(labelled, pages)
    for r in query(spark, "op6_").collect():
        assert r.lang == expected[r.page_id][0]
        assert r.confidence == pytest.approx(expected[r.page_id][1], rel=1e-5)
