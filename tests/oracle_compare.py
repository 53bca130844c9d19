"""Run a registered query in both engines and compare types and rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What tells the two results apart, as bags of rows; empty when nothing does."""
    ours = query(spark, sf_dir).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    ours_types = {f.name: str(f.type) for f in ours.schema}
    theirs_types = {f.name: str(f.type) for f in theirs.schema}
    if ours_types != theirs_types:
        return [f"types {sorted(set(ours_types.items()) ^ set(theirs_types.items()))}"]
    if ours.num_rows == 0:
        return ["no rows"]
    if ours.num_rows != theirs.num_rows:
        return [f"rows {ours.num_rows} and {theirs.num_rows}"]
    con.register("ours", ours.select(theirs.column_names))
    con.register("theirs", theirs)
    try:
        extra = con.execute("SELECT * FROM ours EXCEPT ALL SELECT * FROM theirs").fetchmany(3)
    finally:
        con.unregister("ours")
        con.unregister("theirs")
    return [f"only in ours: {row}" for row in extra]
