"""Temperature model: a random forest, its evaluation and a climatology baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv
from hourgrid.functions import measures
from hourgrid.operators.forest import Forest

#: Rows for each task that cuts the rows into bins.
ROWS_A_TASK = 50_000


def train(
    df: DataFrame,
    features: Sequence[str] = fv.FEATURES,
    trees: int = fv.TREES,
    depth: int = fv.TREE_DEPTH,
    seed: int = fv.SEED,
    histogram_mb: int = 64,
) -> PipelineModel:
    """Fit the forest on all rows of ``df``. No rows is an error.

    ``histogram_mb`` bounds the counts and sums that each task of a pass holds for nodes of too many rows for one task. More
    memory means fewer passes over the data and the same forest.

    Small partitions are put together, to one for ``ROWS_A_TASK`` rows; those of more rows stay as they are. The bags of the
    trees are drawn by place in a partition, so the trees depend on this.
    """
    rows = df.count()
    if not rows:
        raise ValueError("no rows to train on")
    df = df.coalesce(-(-rows // ROWS_A_TASK))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = Forest(
        featuresCol="features",
        labelCol=fv.TARGET,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=histogram_mb,
    )
    return Pipeline(stages=[assembler, forest]).fit(df)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction``; features are taken by name, in the order the model was fitted with."""
    return model.transform(df).drop("features")


def climatology(train_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """Baseline ``prediction``: the mean temperature of the same month and hour."""
    # At most 12 months x 24 hours, hence the broadcast.
    means = train_rows.groupBy("month", "hour").agg(F.avg(fv.TARGET).alias("prediction"))
    return rows.join(F.broadcast(means), ["month", "hour"], "left")


def evaluate(predicted: DataFrame, actual: str = fv.TARGET, prediction: str = "prediction") -> DataFrame:
    """Mean absolute error, R2 and the grade, in one pass."""
    y, p = F.col(actual), F.col(prediction)
    sums = predicted.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sum((y - p) * (y - p)).alias("_error"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_spread"),
    )
    scored = sums.withColumn("r2", 1 - F.try_divide(F.col("_error"), F.col("_spread")))
    return scored.select("rows", "mae", "r2", grade(F.col("r2")).alias("grade"))


def grade(r2):
    return (
        F.when(r2 > fv.R2_EXCELLENT, fv.GRADE_EXCELLENT)
        .when(r2 > fv.R2_GOOD, fv.GRADE_GOOD)
        .otherwise(fv.GRADE_MORE_DATA)
    )


def extents(predicted: DataFrame, actual: str = fv.TARGET, prediction: str = "prediction") -> DataFrame:
    """Common minimum and maximum of actual and predicted values."""
    return predicted.agg(
        measures.positive_zero(F.least(F.min(actual), F.min(prediction))).alias("min_val"),
        measures.positive_zero(F.greatest(F.max(actual), F.max(prediction))).alias("max_val"),
    )
