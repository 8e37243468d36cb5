"""Data checks that gate the pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_KEYS = ("time_id", "location_id")


class GateError(RuntimeError):
    """A stage's output failed its checks; later stages must not run."""


def key_checks(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Not empty, no null in a key, no key twice: three checks from one grouping, which combines
    the rows of a key before the shuffle."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"),
    )
    found = [
        ("not_empty", (F.col("rows") == 0).cast("long")),
        ("null_keys", F.col("nulls")),
        ("unique_keys", F.col("extra")),
    ]
    return totals.select(
        F.inline(F.array(*[F.struct(F.lit(f"{prefix}_{n}").alias("check"), bad.alias("bad_rows")) for n, bad in found]))
    )


def orphans(facts: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Facts whose key the dimension lacks: counted per key before the anti join, so that the
    join sees one row per key and not the facts."""
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = used.join(dim.select(key), key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad_rows"))
    return missing.select(F.lit(name).alias("check"), "bad_rows")


def quality_checks(facts: DataFrame, dim_time: DataFrame, dim_location: DataFrame) -> DataFrame:
    """One row per check: its name, the number of offending rows and whether it passed."""
    facts = facts.select(*FACT_KEYS)
    found = [
        key_checks(facts, FACT_KEYS, "fact"),
        key_checks(dim_time, ["time_id"], "dim_time"),
        key_checks(dim_location, ["location_id"], "dim_location"),
        orphans(facts, dim_time, "time_id", "fact_time_known"),
        orphans(facts, dim_location, "location_id", "fact_location_known"),
    ]
    return reduce(lambda a, b: a.unionByName(b), found).withColumn("passed", F.col("bad_rows") == 0)


def require(checks: DataFrame) -> None:
    """Raise when a check failed."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise GateError("; ".join(f"{r['check']}: {r['bad_rows']} rows" for r in failed))
