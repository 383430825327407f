"""Train/test splits, forests, least squares and their metrics.

Splits are decided per row by a seeded hash of the row's key, so they do not
depend on partitioning or on the order rows arrive in. The hash is 60 bits of an
MD5 sum, which any SQL engine can recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.models import forest
from derrick.operators.aggregates import regression_metrics

#: 15 hexadecimal digits
HASH_RANGE = 1 << 60
#: cells a class's hashes are counted in to find its n-th smallest
CELL_BITS = 16


def key_hash(keys: Sequence[str | Column], seed: int) -> Column:
    """0 <= hash < HASH_RANGE of the keys as text, ``|`` between them and NULL as ``~``."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def split_train_test(df: DataFrame, keys: Sequence[str], test_share: float = 0.25,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """Flag about ``test_share`` of rows as test by a seeded key hash."""
    return df.withColumn(out, key_hash(keys, seed) < F.lit(int(test_share * HASH_RANGE)))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def split_stratified(df: DataFrame, keys: Sequence[str], label: str, test_share: float = 0.25,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """Test share kept exactly within every class (NULL is one): the rows of the
    floor(share n + 1/2) smallest key hashes of the class. Rows of one key share a side.

    The n-th smallest hash of a class comes from mergeable counts: rows are counted
    in 2^16 cells of the hash's upper bits (map-side combined, bounded per class), the
    cell that holds the n-th is known from the running counts, and only that cell's
    rows are ordered. Thresholds are joined as a table, whatever the number of classes.
    """
    h = df.select(F.col(label).alias("c"), key_hash(keys, seed).alias("h"))
    cell = F.shiftright("h", 60 - CELL_BITS)
    counts = h.groupBy("c", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("c").agg(F.floor(F.sum("n") * test_share + 0.5).cast("long").alias("want"))
    running = Window.partitionBy("c").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("upto", F.sum("n").over(running))
    s = sizes.select(F.col("c").alias("sc"), "want")
    found = (counts.join(s, _same(F.col("c"), F.col("sc")))
             .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
             .select("sc", F.col("cell").alias("s_cell"), (F.col("want") - F.col("upto") + F.col("n")).alias("nth")))
    inside = Window.partitionBy("c").orderBy("h")
    cuts = (h.join(found, _same(F.col("c"), F.col("sc")) & (cell == F.col("s_cell")))
            .withColumn("rank", F.row_number().over(inside)).where("rank = nth")
            .select(F.col("c").alias("__class"), F.col("h").alias("__cut")))
    joined = df.join(cuts, _same(df[label], F.col("__class")), "left")
    return joined.select(*[df[c] for c in df.columns if c != out],
                         F.coalesce(key_hash([df[k] for k in keys], seed) <= F.col("__cut"),
                                    F.lit(False)).alias(out))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """scikit-learn ``class_weight="balanced"``: n / (k * n_class), joined per class."""
    counts = df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__k"))      # one row
    weights = counts.join(F.broadcast(whole)).select(
        "__class", (F.col("__all") / (F.col("__k") * F.col("__n"))).alias("__w"))
    joined = df.join(weights, _same(df[label], F.col("__class")), "left")
    return joined.select(*[df[c] for c in df.columns if c != out], F.col("__w").alias(out))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="error")


def fit_linear(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Ordinary least squares (normal equations, no regularisation)."""
    lr = LinearRegression(featuresCol="__features", labelCol=label, predictionCol="prediction",
                          solver="normal", regParam=0.0, elasticNetParam=0.0,
                          standardization=False)
    return Pipeline(stages=[_assembler(features), lr]).fit(train)


def fit_forest_regressor(train: DataFrame, features: Sequence[str], label: str,
                         num_trees: int = 200, seed: int = 42) -> forest.Forest:
    """Fully grown trees; every feature competes at every node."""
    return forest.fit(train, features, label, num_trees=num_trees, seed=seed)


def fit_forest_classifier(train: DataFrame, features: Sequence[str], label: str,
                          weight: str | None = None, num_trees: int = 300,
                          seed: int = 42) -> forest.Forest:
    """Fully grown trees on a 0/1 label; the square root of the number of features
    compete at a node. Predictions are the probability of class 1."""
    return forest.fit(train, features, label, weight, num_trees, max(1, int(len(features) ** 0.5)), seed)


def predict(model: PipelineModel | forest.Forest, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Append the prediction (of a classifier: the probability of class 1) as ``out``."""
    if isinstance(model, forest.Forest):
        return model.predict(df, out)
    keep = [c for c in df.columns if c != out]
    return model.transform(df).select(*keep, F.col("prediction").cast("double").alias(out))


def evaluate(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    return regression_metrics(scored, actual, predicted)
