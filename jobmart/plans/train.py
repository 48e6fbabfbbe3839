"""Salary model (L1–L6, A5, K9) on ``jobs_fact``.

Random-forest regression of ``salary_avg`` on ``location`` and ``level``. Differences
from the original script: a seeded forest; a split by digits of the job id's MD5 instead
of ``randomSplit`` (whose assignment changes with partitioning); and, as locations are
free text whose number grows with the data, the forest's features are the train split's
mean salary per location and per level instead of their indices. So no list of labels
reaches the driver and the forest needs a fixed number of bins. The indices themselves
(L2) are a distributed count, sort and join.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.sources.sinks import save_model

CATEGORIES = ("location", "level")
LABEL = "salary_avg"
NUM_TREES = 50
MAX_BINS = 64
SEED = 42
TRAIN_PERCENT = 80
_ENCODED = {"location": "location_mean", "level": "level_mean"}


def training_source(fact: DataFrame) -> DataFrame:
    """L1: rows with a positive salary. The filter reaches a mart's parquet scan; over
    raw postings the salary is computed first."""
    return fact.where(F.col(LABEL) > 0)


def hash_split(df: DataFrame, key: str = "job_id", percent: int = TRAIN_PERCENT) -> DataFrame:
    """``is_train`` from the first 32 bits of the key's MD5: the same rows land in
    the same split whatever the partitioning."""
    digits = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_train", digits % 100 < percent)


def feature_columns(df: DataFrame) -> list[str]:
    """Only the categorical columns the frame has."""
    return [c for c in CATEGORIES if c in df.columns]


def label_index(df: DataFrame, column: str, work_dir: str) -> DataFrame:
    """L2: (label, index) by falling frequency, ties by label; nulls have no index.

    A global row number without one big task: the distinct labels are range-sorted and
    written, numbered within their file, and shifted by the files' running sizes."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc(column)]
    ranged = counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(work_dir)
    stored = df.sparkSession.read.parquet(work_dir)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return stored.withColumn("_own", own).join(shift, "_part").select(
        F.col(column).alias("label"), (F.col("_own") + F.col("_shift") - 1).cast("double").alias("index")
    )


class LabelEncoder:
    """L2 as a fitted model: the label table of some rows, saved, and applied to any rows
    by a join. A label that the table lacks, and null, get the extra index behind all
    labels (``handleInvalid="keep"``)."""

    def __init__(self, spark: SparkSession, column: str, path: str):
        self.column, self.table = column, spark.read.parquet(path)

    @classmethod
    def fit(cls, rows: DataFrame, column: str, path: str) -> LabelEncoder:
        label_index(rows, column, path + "-counts").write.mode("overwrite").parquet(path)
        return cls(rows.sparkSession, column, path)

    def transform(self, rows: DataFrame, out_col: str) -> DataFrame:
        keep = F.lit(self.table.agg(F.count(F.lit(1)).cast("double")).first()[0])
        table = self.table.select(F.col("label").alias(self.column), F.col("index").alias(out_col))
        return rows.join(table, self.column, "left").withColumn(out_col, F.coalesce(out_col, keep))


def encode_means(rows: DataFrame) -> DataFrame:
    """L3: rows (with ``is_train`` and the label) with the train split's mean salary of
    each category; a category that the train split lacks gets the overall mean."""
    train = rows.where("is_train")
    overall = F.lit(train.agg(F.avg(LABEL)).first()[0]).cast("double")
    out = rows
    for c in feature_columns(rows):
        means = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.avg(LABEL).alias("_mean"))
        out = out.join(means, c, "left").withColumn(_ENCODED[c], F.coalesce("_mean", overall)).drop("_mean")
    return out


def cell_means(rows: DataFrame) -> DataFrame:
    """``rows`` with ``cell_mean``, the train split's mean salary of the row's location and
    level together (nulls are values here); the overall mean where training lacks them."""
    train = rows.where("is_train")
    columns = feature_columns(rows)
    means = train.groupBy(*(F.col(c).alias("_" + c) for c in columns)).agg(F.avg(LABEL).alias("cell_mean"))
    same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in columns]
    overall = F.lit(train.agg(F.avg(LABEL)).first()[0]).cast("double")
    out = rows.join(means, same, "left").drop(*("_" + c for c in columns))
    return out.withColumn("cell_mean", F.coalesce("cell_mean", overall))


def evaluate(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """A5: RMSE on the test rows, with split sizes and the label's spread, in one aggregate."""
    err = F.pow(F.col(LABEL) - F.col(prediction), 2)
    return predictions.agg(
        F.sqrt(F.avg(F.when(~F.col("is_train"), err))).alias("rmse"),
        F.count_if(F.col("is_train")).cast("bigint").alias("n_train"),
        F.count_if(~F.col("is_train")).cast("bigint").alias("n_test"),
        F.stddev_pop(F.when(~F.col("is_train"), F.col(LABEL))).alias("spread"),
    )


def feature_rows(fact: DataFrame, work_dir: str) -> DataFrame:
    """The model's rows, written once to the shared folder ``work_dir`` (every
    tree pass reads them: it cuts the lineage and survives lost executors)."""
    source = training_source(fact)
    rows = hash_split(source.select("job_id", *feature_columns(source), LABEL))
    if not feature_columns(rows):
        raise ValueError("need at least one of: " + ", ".join(CATEGORIES))
    encode_means(rows).write.mode("overwrite").parquet(work_dir)
    return fact.sparkSession.read.parquet(work_dir)


def fit(rows: DataFrame) -> PipelineModel:
    """The forest on the train split."""
    inputs = [_ENCODED[c] for c in feature_columns(rows)]
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, numTrees=NUM_TREES, maxBins=MAX_BINS, seed=SEED
    )
    stages = [VectorAssembler(inputCols=inputs, outputCol="features"), forest]
    return Pipeline(stages=stages).fit(rows.where("is_train"))


def train(fact: DataFrame, model_path: str, work_dir: str) -> tuple[PipelineModel | None, DataFrame]:
    """Fit, save (K9) and predict: (model, the rows with ``prediction``). Without a row of
    a positive salary (L1) there is no model and the predictions are empty."""
    rows = feature_rows(fact, work_dir)
    if rows.where("is_train").isEmpty():
        return None, rows.withColumn("prediction", F.lit(None).cast("double"))
    model = fit(rows)
    save_model(model, model_path)
    return model, model.transform(rows).drop("features")


def reload(model_path: str) -> PipelineModel:
    """K9: the saved pipeline."""
    return PipelineModel.load(model_path)
