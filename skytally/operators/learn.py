"""k-means clusters and a random-forest classifier on assembled feature columns."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

# The settings of the two jobs.
KMEANS_SETTINGS = {"k": 4, "maxIter": 100, "initMode": "random", "seed": 0}
FOREST_SETTINGS = {
    "numTrees": 3, "maxDepth": 5, "maxBins": 32, "impurity": "gini", "featureSubsetStrategy": "auto", "seed": 12345,
}


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows with a ``features`` vector; rows with a missing feature are left out."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)


def fit_kmeans(points: DataFrame, **settings) -> KMeansModel:
    return KMeans(**(KMEANS_SETTINGS | settings)).fit(points)


def kmeans_members(model: KMeansModel, points: DataFrame, name: str = "title") -> DataFrame:
    """(cluster, name), one row per member: a cluster may hold any share of the rows, so it is not one list."""
    return model.transform(points).select(F.col("prediction").alias("cluster"), name)


def kmeans_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def fit_forest(points: DataFrame, **settings) -> RandomForestClassificationModel:
    """Two-class forest on ``features`` and ``label``."""
    # A copy has no training summary: that holds the session, which cannot be sent to tasks once it has observed metrics.
    return RandomForestClassifier(**(FOREST_SETTINGS | settings)).fit(points).copy()


def classify(model: RandomForestClassificationModel, points: DataFrame, *keep: str) -> DataFrame:
    """``prediction`` and the kept columns (the features unless named otherwise)."""
    return model.transform(points).select("prediction", *(keep or ("features",)))
