"""Stock-out classifier: random forest on stock, lead time and daily demand.

The 80/20 split is a hash of the row key with the seed, so it does not
depend on partitioning and is identical when a task is recomputed after an
executor loss (``randomSplit`` samples per partition in partition order).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Features, label, test share, seed, forest size.
FEATURES = ("current_stock", "lead_time", "avg_daily_demand")
LABEL = "stockout"
TEST_FRACTION = 0.2
SEED = 42
HASH_FACTOR, HASH_STEP = 2654435761, 40503  # 2^32 and 2^16 over the golden ratio
N_TREES = 100
TRAIN_ROWS = 200_000  # rows of a training partition
MAX_DEPTH = 30  # the deepest Spark allows; scikit-learn grows trees without a limit


def train_test_split(df: DataFrame, key: str, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' from a seeded multiplicative hash of the
    integer ``key``; plain arithmetic, so other engines split alike.  A NULL key
    is training data."""
    x = F.pmod(F.col(key).cast("long"), F.lit(1 << 30)) * HASH_FACTOR + seed * HASH_STEP
    u = (x % F.lit(1 << 32)) / F.lit(float(1 << 32))
    return df.withColumn("split", F.when(u < test_fraction, "test").otherwise("train"))


class _Forest(RandomForestClassifier):
    """A random forest whose model can be sent to tasks at any time: a fitted model carries its
    training summary, and with it the session, which is not serializable once a query has
    been observed.  A copy of the model leaves the summary behind."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        return super()._fit(dataset).copy()


def stockout_pipeline(n_trees: int = N_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED) -> Pipeline:
    asm = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    # cached node ids: a pass over the rows does not walk every tree from its root, and trees are not sent to tasks
    rf = _Forest(labelCol=LABEL, featuresCol="features", numTrees=n_trees, maxDepth=max_depth, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[asm, rf])


def _training(df: DataFrame, key: str) -> DataFrame:
    """``df`` (materialised) in a partition for every TRAIN_ROWS rows, in the key's order.  Every
    task of a pass sends the statistics of all tree nodes, so few tasks send little; and as
    rows are drawn by partition, the forest is the same on any cluster."""
    tasks = -(-df.count() // TRAIN_ROWS)
    if tasks <= 1:
        return df.coalesce(1)
    return df.repartition(tasks, key).sortWithinPartitions(key, *FEATURES, LABEL)


def _split_once(df: DataFrame, key: str) -> DataFrame:
    """The split features, materialised: fitting and scoring read them often."""
    ensure_checkpoint_dir(df.sparkSession)
    return train_test_split(df, key).checkpoint(eager=True)


def fit_stockout(df: DataFrame, key: str = "product_id") -> tuple[PipelineModel, DataFrame]:
    """Fit on the train split; return the model and scored test rows."""
    s = _split_once(df, key)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    model = stockout_pipeline().fit(_training(train, key))
    return model, scored(model, test)


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` (materialised) with the model's predictions, in no more tasks than there are cores:
    each of them reads the whole forest."""
    return model.transform(df.coalesce(df.sparkSession.sparkContext.defaultParallelism))


def stockout_report(df: DataFrame, key: str = "product_id") -> DataFrame:
    """One row: train/test sizes, test accuracy, stock-outs among the test rows and how many
    of them were foreseen (all computed on the cluster)."""
    s = _split_once(df, key)
    model = stockout_pipeline().fit(_training(s.where(F.col("split") == "train"), key))
    hit = (F.col("prediction") == F.col(LABEL).cast("double")).cast("int")
    return scored(model, s).agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        (F.sum(F.when(F.col("split") == "test", hit)) / F.count_if(F.col("split") == "test")).alias("accuracy"),
        F.count_if((F.col("split") == "test") & (F.col(LABEL) == 1)).alias("test_stockouts"),
        F.count_if((F.col("split") == "test") & (F.col(LABEL) == 1) & (F.col("prediction") == 1)).alias("foreseen"))
