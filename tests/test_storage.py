"""Layer tables: evolution, repeated loads, registration, compaction, staging."""

from datetime import date
from glob import glob
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tripstrata.operators.enrich import add_ingest_metadata
from tripstrata.plans import flows
from tripstrata.plans.rules import RATE_CODE_SCHEMA, RATE_CODES, VENDOR_SCHEMA, VENDORS
from tripstrata.sources import clustering, readers, writers
from tripstrata.sources.scratch import scratch_dir


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "test")


def load(spark, rows, schema, day):
    return add_ingest_metadata(spark.createDataFrame(rows, schema), "s", day)


def files(path):
    return glob(f"{path}/**/*.parquet", recursive=True)


def test_scratch_lies_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "a").startswith(shared)
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_local_session_without_the_setting_gets_a_folder():
    class Local:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "local[2]"}.get(key, default)

        class sparkContext:
            applicationId = "local-test"

    one, two = scratch_dir(Local, "a"), scratch_dir(Local, "a")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster, "a")


def test_append_gains_columns(spark, path):
    writers.append_evolving(load(spark, [(1,)], "a INT", "2024-01-01"), path)
    writers.append_evolving(load(spark, [(2, "x")], "a INT, b STRING", "2024-01-02"), path)
    writers.append_evolving(load(spark, [(3,)], "a INT", "2024-01-03"), path)
    table = readers.read_layer(spark, path, evolved=True)
    rows = [tuple(r) for r in table.select("a", "b").orderBy("a").collect()]
    assert rows == [(1, None), (2, "x"), (3, None)]
    given = readers.read_layer(spark, path, schema=table.schema)
    assert sorted(given.collect(), key=str) == sorted(table.collect(), key=str)


def test_append_returns_the_schema_to_read_and_to_append_with(spark, path):
    loads = [
        load(spark, [(1, "x")], "a INT, b STRING", "2024-01-01"),
        load(spark, [(2,)], "a INT", "2024-01-02"),
        load(spark, [(3, 4)], "a INT, c INT", "2024-01-03"),
    ]
    known = None
    for df in loads:
        known = writers.append_evolving(df, path, before=known)
    table = readers.read_layer(spark, path, schema=known)
    assert set(table.dtypes) == {
        ("a", "int"), ("b", "string"), ("c", "int"), ("ingest_date", "date"), ("source", "string")
    }
    rows = [tuple(r) for r in table.select("a", "b", "c").orderBy("a").collect()]
    assert rows == [(1, "x", None), (2, None, None), (3, None, 4)]
    with pytest.raises(TypeError, match="'b'"):
        writers.append_evolving(load(spark, [(1,)], "b INT", "2024-01-04"), path, before=known)


def test_names_are_compared_without_case(spark, path):
    writers.append_evolving(load(spark, [(1.0,)], "airport_fee DOUBLE", "2024-01-01"), path)
    schema = writers.append_evolving(load(spark, [(2.0, 7)], "Airport_fee DOUBLE, b INT", "2024-01-02"), path)
    assert [f.name for f in schema if f.name.lower() == "airport_fee"] == ["airport_fee"]
    rows = readers.read_layer(spark, path).select("airport_fee", "b").orderBy("airport_fee").collect()
    assert [tuple(r) for r in rows] == [(1.0, None), (2.0, 7)]
    with pytest.raises(TypeError, match="airport_fee"):
        writers.append_evolving(load(spark, [("x",)], "AIRPORT_FEE STRING", "2024-01-03"), path)


def test_loads_read_no_old_footers(spark, path, jobs_run):
    """The work of a load does not grow with the loads before it."""
    jobs = []
    for n in range(6):
        df = load(spark, [(n,)], "a INT", f"2024-01-0{n + 1}").repartition(2)
        jobs.append(jobs_run(lambda df=df: writers.append_evolving(df, path)))
    assert len(set(jobs[1:])) == 1
    assert readers.recorded_schema(spark, path).names == ["a", "ingest_date", "source"]
    assert readers.read_layer(spark, path).count() == 6


def test_compaction_and_registration_keep_added_columns(spark, path):
    name = f"evolved_{uuid4().hex}"
    writers.append_evolving(load(spark, [(1,)], "a INT", "2024-01-01"), f"{path}/t")
    assert "b" not in writers.register_table(spark, name, f"{path}/t", partition_by=["ingest_date"]).columns
    writers.append_evolving(load(spark, [(2, "x")], "a INT, b STRING", "2024-01-02"), f"{path}/t")
    packed = writers.compact_table(spark, f"{path}/t", f"{path}/packed", ["ingest_date"])
    shown = writers.register_table(spark, name, f"{path}/t", partition_by=["ingest_date"])
    for table in (packed, shown, readers.read_layer(spark, f"{path}/packed")):
        assert sorted(map(tuple, table.select("a", "b").collect())) == [(1, None), (2, "x")]
    with pytest.raises(ValueError, match="shows"):
        writers.register_table(spark, name, f"{path}/packed", partition_by=["ingest_date"])


def test_overwrite_under_a_dynamic_session(spark, path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2024-01-01", "2024-01-02"):
            writers.overwrite(spark.createDataFrame([(1, day)], "n INT, date STRING"), path, ["date"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert readers.read_layer(spark, path).count() == 1


def test_rebalance_needs_adaptive_execution(spark, path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="adaptive"):
            writers.overwrite(spark.range(3).withColumn("k", F.lit(1)), path, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_publish_again(spark, path):
    """A second publish shows its own rows, and the plan of the first keeps its files."""
    name = f"gold_{uuid4().hex}"

    def day(n):
        return spark.createDataFrame([(n, date(2024, 1, n))], "n INT, date DATE")

    first = flows.publish(day(1), f"{path}/gold", name, compacted_path=f"{path}/packed")
    second = flows.publish(day(2), f"{path}/gold", name)
    assert [r.n for r in second.collect()] == [r.n for r in spark.table(name).collect()] == [2]
    assert [r.n for r in first.collect()] in ([1], [2])
    wider = day(3).withColumn("m", F.lit(1))
    assert flows.publish(wider, f"{path}/gold", name).select("n", "m").collect() == [(3, 1)]
    empty = flows.publish(day(1).limit(0), f"{path}/gold", name)
    assert empty.count() == 0 and spark.table(name).count() == 0
    assert flows.publish(day(1).limit(0), f"{path}/plain").count() == 0
    with pytest.raises(ValueError, match="not published"):
        flows.publish(day(1), f"{path}/elsewhere", name)


def test_append_refuses_another_type(spark, path):
    writers.append_evolving(load(spark, [(1,)], "a INT", "2024-01-01"), path)
    with pytest.raises(TypeError, match="'a'"):
        writers.append_evolving(load(spark, [("x",)], "a STRING", "2024-01-02"), path)


def test_fixed_append_refuses_another_schema(spark, path):
    writers.append_fixed(load(spark, [(1,)], "a INT", "2024-01-01"), path)
    for rows, schema in ([(1, 2)], "a INT, b INT"), ([("x",)], "a STRING"):
        with pytest.raises(TypeError, match="schema"):
            writers.append_fixed(load(spark, rows, schema, "2024-01-01"), path)
    assert readers.read_layer(spark, path).count() == 1


def test_repeated_load_doubles_or_replaces(spark, path):
    first = load(spark, [(1,)], "a INT", "2024-01-01")
    second = load(spark, [(2,)], "a INT", "2024-01-02")
    for df in (first, second, second):
        writers.append_fixed(df, path)
    assert readers.read_layer(spark, path).count() == 3
    writers.append_fixed(second, path, mode="replace_partitions")
    assert sorted(r.a for r in readers.read_layer(spark, path).collect()) == [1, 2]
    with pytest.raises(ValueError, match="mode"):
        writers.append_fixed(second, path, mode="upsert")


def test_since_reads_only_later_partitions(spark, path):
    for day in ("2024-01-01", "2024-01-02"):
        writers.append_fixed(load(spark, [(1,)], "a INT", day), path)
    late = readers.read_layer(spark, path, since="2024-01-02")
    assert [r.ingest_date for r in late.collect()] == [date(2024, 1, 2)]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_overwrite_and_codec(spark, path):
    for rows in ([(1,), (2,)], [(3,)]):
        writers.overwrite(spark.createDataFrame(rows, "a INT"), path)
    assert [r.a for r in readers.read_layer(spark, path).collect()] == [3]
    assert all(name.endswith(".zstd.parquet") for name in files(path))
    writers.overwrite(spark.createDataFrame([(1,)], "a INT"), path, codec="gzip")
    assert all(name.endswith(".gz.parquet") for name in files(path))


def test_partitioned_overwrite_replaces_the_whole_table(spark, path):
    for day in ("2024-01-01", "2024-01-02"):
        df = spark.createDataFrame([(1, date.fromisoformat(day))], "n INT, date DATE")
        writers.overwrite(df, path, ["date"])
    assert [str(r.date) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]


def test_registered_table_sees_partitions(spark, path):
    name = f"registered_{uuid4().hex}"
    df = spark.range(6).withColumn("k", F.col("id") % 3)
    writers.overwrite(df, path, ["k"])
    for _ in range(2):
        assert writers.register_table(spark, name, path, partition_by=["k"]).count() == 6
    writers.append_fixed(df, path, ["k"])
    assert writers.refresh_table(spark, name, partitioned=True).count() == 12


def test_compaction_keeps_rows_in_fewer_files(spark, path):
    df = spark.range(3000).withColumn("k", F.col("id") % 3)
    writers.overwrite(df.repartition(8), f"{path}/loose", ["k"], rebalance=False)
    packed = writers.compact_table(spark, f"{path}/loose", f"{path}/packed", ["k"])
    assert len(files(f"{path}/loose")) == 24 and len(files(f"{path}/packed")) == 3
    assert packed.exceptAll(spark.read.parquet(f"{path}/loose")).count() == 0
    assert packed.count() == 3000


def test_compaction_splits_a_hot_partition(spark, path):
    """A partition value with most of the rows is written by several tasks."""
    wide = spark.range(400_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 4).otherwise(9).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    writers.overwrite(wide.repartition(8), f"{path}/loose", ["k"], rebalance=False)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], str(4 << 20))
        packed = writers.compact_table(spark, f"{path}/loose", f"{path}/packed", ["k"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files(f"{path}/packed/k=9")) > 1
    assert packed.count() == 400_000


def test_compacted_copy_takes_over_a_registered_table(spark, path):
    name = f"gold_{uuid4().hex}"
    df = spark.sql("SELECT id AS n, date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS date FROM range(30)")
    table = flows.publish(df, f"{path}/gold", name, compacted_path=f"{path}/gold-compact")
    assert table.count() == 30 and spark.table(name).count() == 30
    assert len(files(f"{path}/gold")) == len(files(f"{path}/gold-compact")) == 3
    assert all("gold-compact" in f for f in spark.table(name).inputFiles())


def test_stage_reads_back_the_same_rows_with_pruned_columns(spark, path):
    df = spark.range(10).select("id", (F.col("id") / 2).alias("x"), F.lit("s").alias("s"))
    staged = writers.stage(df, path)
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert sorted(staged.collect()) == sorted(df.collect())
    plan = staged.agg(F.sum("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:double>" in plan


def test_csv_with_and_without_schema(spark, path):
    spark.createDataFrame([(1, "a"), (2, "b")], "`Zone ID` INT, Name STRING").write.csv(path, header=True)
    given = readers.read_csv(spark, path, "`Zone ID` INT, Name STRING")
    assert sorted(given.collect()) == sorted(readers.read_csv(spark, path).collect()) == [(1, "a"), (2, "b")]


def test_stage_leaves_earlier_stages_alone(spark, path):
    first = writers.stage(spark.range(3), path)
    assert writers.stage(first.filter("id > 0"), path).count() == 2
    assert first.count() == 3


def test_csv_schema_must_fit(spark, path):
    spark.createDataFrame([(1, "x")], "a INT, b STRING").write.csv(path, header=True)
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_csv(spark, path, "b STRING, a STRING").collect()
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        readers.read_csv(spark, path, "a INT, b INT").collect()
    assert readers.read_csv(spark, path, "a INT, b INT", mode="PERMISSIVE").collect() == [(1, None)]


def test_dimensions(spark, path):
    spark.createDataFrame([(1, "a")], "LocationID INT, Zone STRING").write.csv(f"{path}/csv", header=True)
    paths = flows.dimensions(spark, path, f"{path}/csv")
    tables = {name: spark.read.parquet(p) for name, p in paths.items()}
    assert sorted(tables["dim_vendor"].collect()) == sorted(VENDORS)
    assert sorted(tables["dim_rate_code"].collect()) == sorted(RATE_CODES)
    assert tables["dim_location"].columns == ["location_id", "zone"]
    assert readers.literal_table(spark, VENDORS, VENDOR_SCHEMA).count() == 2
    assert readers.literal_table(spark, RATE_CODES, RATE_CODE_SCHEMA).count() == 6


def test_clustered_files_are_narrow_in_every_column(spark, path):
    rows = spark.range(0, 20_000, 1, 8).select(
        (F.xxhash64("id") % 1000).alias("a"), F.expr("DATE'2024-01-01' + CAST(pmod(xxhash64(id, 7), 365) AS INT)").alias("b"), "id"
    )
    rows.write.parquet(f"{path}/loose")
    packed = clustering.cluster_table(spark, f"{path}/loose", f"{path}/packed", ["a", "b"], 16)
    assert packed.exceptAll(rows).count() == 0 and packed.count() == 20_000
    found = clustering.file_ranges(packed, ["a", "b"]).collect()
    assert len(found) == 16 and max(r.n_rows for r in found) < 2 * 20_000 / 16
    # Four by four boxes, a quarter of either column each; a file may reach over the bound of two.
    assert sum(r.max_a - r.min_a for r in found) / 16 < 0.5 * 2000
    assert sum((r.max_b - r.min_b).days for r in found) / 16 < 0.5 * 365
    corner = [r for r in found if r.min_a <= -800 and r.min_b <= date(2024, 2, 1)]
    assert 1 <= len(corner) <= 3


def test_clustering_spreads_a_hot_value_and_keeps_nulls(spark, path):
    value = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 5.0).when(F.col("id") % 50 == 0, float("nan"))
    rows = spark.range(0, 30_000, 1, 4).select(value.otherwise(F.col("id")).alias("x"), F.lit(None).cast("int").alias("_cell"), F.lit(1).alias("y"))
    rows.write.parquet(f"{path}/loose")
    packed = clustering.cluster_table(spark, f"{path}/loose", f"{path}/packed", ["x", "_cell"], 10)
    assert packed.columns == rows.columns
    assert packed.exceptAll(rows).count() == 0 and packed.count() == 30_000
    assert max(r.n_rows for r in clustering.file_ranges(packed, ["x"]).collect()) < 2 * 3000


def test_clustering_refuses_what_has_no_quantiles(spark, path):
    spark.range(3).selectExpr("id", "'a' AS s").limit(0).write.parquet(f"{path}/loose")
    assert clustering.cluster_table(spark, f"{path}/loose", f"{path}/packed", ["id"], 4).count() == 0
    for columns in (["s"], [], ["id", "id"], ["gone"]):
        with pytest.raises(ValueError):
            clustering.cluster_table(spark, f"{path}/loose", f"{path}/other", columns, 4)
