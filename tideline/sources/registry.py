"""Fitted models on shared storage, and the record of which states are done."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.config import TREES
from tideline.functions.scalars import model_key

KEY = "state"
OK, FAILED, SKIPPED = "ok", "failed", "skipped"
PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


class ModelRegistry:
    """Models by name under one folder.

    A closed-form model is its coefficient table. A pooled model is saved by the ML library,
    next to the scale table that holds its series. ``entries`` lists one key per fitted pair of
    state and model, partitioned by model.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def save_coefficients(self, model: str, fit: DataFrame) -> None:
        fit.write.mode("overwrite").parquet(self._coefficients(model))
        self._list(model, self.load_coefficients(model))

    def load_coefficients(self, model: str) -> DataFrame:
        return self.spark.read.parquet(self._coefficients(model))

    def save_pooled(self, model: str, fitted: MLWritable, scale: DataFrame) -> None:
        fitted.write().overwrite().save(f"{self.folder}/pooled/{model}")
        self.save_coefficients(model, scale)

    def load_pooled(self, model: str, kind: type[MLReadable]) -> tuple:
        """The fitted model and its scale table."""
        fitted = kind.load(f"{self.folder}/pooled/{model}")
        return fitted, self.load_coefficients(model)

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/entries")

    def models(self) -> set[str]:
        """Names of the saved models; a handful, whatever the number of states."""
        return {row.model for row in self.entries().select("model").distinct().collect()}

    def _coefficients(self, model: str) -> str:
        return f"{self.folder}/coefficients/{model}"

    def _list(self, model: str, fit: DataFrame) -> None:
        keys = fit.select(KEY).distinct().withColumn("key", model_key(F.col(KEY), F.lit(model)))
        keys.write.mode("overwrite").parquet(f"{self.folder}/entries/model={model}")


def available_states(entries: DataFrame, model: str = TREES) -> DataFrame:
    """States that have a saved model of the given kind, sorted."""
    return entries.filter(F.col("model") == model).select(KEY).distinct().orderBy(KEY)


def available_count(entries: DataFrame, model: str = TREES) -> DataFrame:
    """How many states have a saved model of the given kind."""
    return available_states(entries, model).agg(F.count("*").alias("n_states"))


class Progress:
    """Append-only record of processed states; a batch is one committed write."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.path = f"{folder}/progress"

    def record(self, states: DataFrame) -> None:
        """Append ``states(state, status, n_rows)``: one commit for a whole batch."""
        states.write.mode("append").parquet(self.path)

    def completed(self) -> DataFrame:
        """States processed so far; none before the first record."""
        try:
            return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)


def remaining_states(sales: DataFrame, completed: DataFrame) -> DataFrame:
    """States of the data that have not been processed."""
    return sales.select(KEY).distinct().join(completed, KEY, "left_anti")


def all_completed(earlier: DataFrame, batch: DataFrame) -> DataFrame:
    """Distinct states of two records."""
    return earlier.select(KEY).union(batch.select(KEY)).distinct()


def remaining_sales(sales: DataFrame, completed: DataFrame) -> DataFrame:
    """Sales rows of the states still to be processed."""
    return sales.join(completed.select(KEY).distinct(), KEY, "left_anti")


def unsettled_sales(sales: DataFrame, progress: DataFrame) -> DataFrame:
    """Sales rows of the states a run has to take up: new ones, failed ones, and grown ones.

    A state that was too short is tried again once it has more rows than it had then; a state
    that failed is always tried again.
    """
    settled = progress.filter(F.col("status") == OK).select(KEY)
    short = progress.filter(F.col("status") == SKIPPED).groupBy(KEY).agg(
        F.max("n_rows").alias("n_tried")
    )
    sizes = sales.groupBy(KEY).agg(F.count("*").alias("n_rows"))
    same = sizes.join(short, KEY).filter("n_rows <= n_tried").select(KEY)
    return remaining_sales(sales, settled.unionByName(same))
