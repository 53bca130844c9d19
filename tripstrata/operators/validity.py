"""Join with a dimension whose rows hold for a range of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SECONDS = 86_400


def join_valid(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    days: int = 90,
) -> DataFrame:
    """The facts with the rows of the dimension that hold for their key at their time.

    A row holds from ``valid_from`` on, up to but without ``valid_to``; null is open.  Both
    tables have ``key``; their other columns must differ.  Facts without such a row stay
    once, with nulls, as do those of null key or time.  Rows that hold at the same time
    match both, as in a join by range.

    Time is cut into buckets of so many days; a dimension row is repeated for each bucket
    that it reaches into, and rows meet by key and bucket: an equi-join, with the range
    checked on what meets.  A key with a third of the facts is spread over its buckets.
    Open ranges end where the facts do, which is one more pass over their time column; a
    dimension row is repeated once per bucket of the facts at most.
    """
    clash = (set(facts.columns) & set(dimension.columns)) - {key}
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    if days <= 0:
        raise ValueError(f"days must be positive: {days}")

    def bucket(time):
        return F.floor(F.unix_seconds(time.cast("timestamp")) / (days * _SECONDS))

    # Names of the helpers must not meet those of a caller.
    taken = {*facts.columns, *dimension.columns}
    slot, own = (next(n for k in range(len(taken) + 1) if (n := f"_{stem}{k}") not in taken) for stem in ("slot", "own"))
    span = facts.agg(F.struct(F.min(bucket(F.col(at))).alias("low"), F.max(bucket(F.col(at))).alias("high"))).scalar()
    first = F.greatest(bucket(F.col(valid_from)), span.getField("low"))
    last = F.least(bucket(F.col(valid_to)), span.getField("high"))
    reached = F.when(first <= last, F.sequence(first, last))
    held = dimension.filter(F.col(key).isNotNull()).withColumn(slot, F.explode(reached)).withColumnRenamed(key, own)
    keyed = facts.withColumn(slot, bucket(F.col(at)))
    holds = (
        (keyed[key] == held[own])
        & (keyed[slot] == held[slot])
        & (F.col(valid_from).isNull() | (F.col(valid_from) <= F.col(at)))
        & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    )
    joined = keyed.join(held, holds, "left")
    return joined.select(*facts.columns, *[c for c in dimension.columns if c != key])
