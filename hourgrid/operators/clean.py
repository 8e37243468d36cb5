"""Cleaning of raw streams: grid flattening, version merge, canonical columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv

AUXILIARY = ("expver", "number")


def flatten_grid(
    df: DataFrame, axes: Sequence[str], variables: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per grid cell from rows that hold a whole grid.

    ``axes`` are array columns, slowest first; each variable is an array in row-major order over
    them; one of another length is an error. The position in the array gives every axis value by
    arithmetic, so nothing is joined.
    """
    cells_of_axes = reduce(lambda a, b: a * b, [F.size(a) for a in axes], F.lit(1))

    def fitting(name: str) -> Column:
        size = F.size(name)
        wrong = F.raise_error(F.format_string(f"{name}: %d values for a grid of %d cells", size, cells_of_axes))
        return F.when(F.col(name).isNull() | (size == cells_of_axes), F.col(name)).otherwise(wrong)

    cells = df.select(
        *keep, *axes, F.posexplode(F.arrays_zip(*[fitting(v).alias(v) for v in variables])).alias("_pos", "_cell")
    )

    def axis_value(i: int) -> Column:
        stride = reduce(lambda a, b: a * b, [F.size(a) for a in axes[i + 1 :]], F.lit(1))
        index = F.call_function("div", F.col("_pos"), stride)
        if i > 0:
            index = index % F.size(axes[i])
        return F.element_at(F.col(axes[i]), (index + 1).cast("int"))

    return cells.select(
        *keep,
        *[axis_value(i).alias(a) for i, a in enumerate(axes)],
        *[F.col("_cell")[v].alias(v) for v in variables],
    )


def _no_nan(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    return F.when(~F.isnan(value), value) if dict(df.dtypes)[name] in ("float", "double") else value


def merge_versions(
    df: DataFrame, keys: Sequence[str], variables: Sequence[str], version: str = "expver"
) -> DataFrame:
    """Per cell and variable the preliminary version's value, else the final version's, else that of
    a row without a version.

    Each cell is decided by its own rows, so files with and without versions can be mixed. One
    aggregation with map-side combine in place of a full outer join of the versions.
    """
    picked = [(fv.PRELIMINARY_VERSION, "_first"), (fv.FINAL_VERSION, "_second"), (None, "_third")]
    known = F.col(version).isNull() | F.col(version).isin([v for v, _ in picked if v is not None])
    merged = (
        df.where(known)
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col(version).eqNullSafe(v), _no_nan(df, name))).alias(name + suffix)
                for name in variables
                for v, suffix in picked
            ]
        )
    )
    return merged.select(*keys, *[F.coalesce(*[n + suffix for _, suffix in picked]).alias(n) for n in variables])


def clean_stream(df: DataFrame, variables: Sequence[str], versions: bool = False) -> DataFrame:
    """Canonical stream: ``time, latitude, longitude`` and the variables, nothing else.

    ``valid_time`` becomes ``time``; auxiliary columns go; time gets microsecond precision without
    a zone. With ``versions`` cells may come in several data versions or in none, which are merged first.
    """
    if "valid_time" in df.columns:
        if "time" in df.columns:
            df = df.withColumn("time", F.coalesce("time", "valid_time")).drop("valid_time")
        else:
            df = df.withColumnRenamed("valid_time", "time")
    df = df.withColumn("time", F.col("time").cast("timestamp_ntz"))
    if versions:
        df = merge_versions(df, fv.JOIN_KEYS, variables)
    return df.drop(*AUXILIARY).select(*fv.JOIN_KEYS, *variables)
