"""k-means similarity between entities (MLlib pipeline)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawhouse.session import default_parallelism, materialize


class Clustering(NamedTuple):
    """``assigned``: (key, scaled features as an array, prediction); ``centres``
    in the order of the predictions; ``model`` the whole fitted pipeline."""

    assigned: DataFrame
    centres: list[list[float]]
    model: PipelineModel


def fit_clusters(
    df: DataFrame,
    key: str,
    features: Sequence[str] | None = None,
    k: int = 100,
    seed: int = 1,
    max_iter: int = 20,
    tol: float = 1e-4,
    handle_invalid: str = "error",
) -> Clustering:
    """Assemble the feature columns, scale them to unit standard deviation (no
    centering) and fit k-means.

    ``seed`` makes the assignment repeatable.  ``handle_invalid`` is the
    VectorAssembler policy for NULL features ('error', 'skip' or 'keep').  Fewer
    distinct points than ``k`` are an error, never a silently smaller ``k``.
    Each iteration is one distributed pass; only the ``k`` centres travel to the
    executors.  The input is usually an expensive lazy plan read by several
    passes, so it is written once to the checkpoint folder first.
    """
    cols = list(features) if features else [c for c in df.columns if c != key]
    # dealt and sorted by key before it is written: k-means|| samples per partition,
    # so a fixed seed repeats only if partitions and their order repeat too
    dealt = df.select(key, *cols).repartition(default_parallelism(df.sparkSession), key).sortWithinPartitions(key)
    df = materialize(dealt, "kmeans-input")
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid=handle_invalid),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=False, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="_features", predictionCol="prediction"),
    ])
    model = pipeline.fit(df)
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    if len(centres) < k:
        raise ValueError(f"k = {k}, but there are only {len(centres)} distinct points")
    return Clustering(assign(model, df, key), centres, model)


def assign(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """(key, scaled features, prediction) of any entities by a fitted pipeline:
    its own scaling and centres, no refit; one pass without a shuffle."""
    return model.transform(df).select(key, vector_to_array("_features").alias("scaled"), "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted pipeline (scaler and centres) in a new shared folder."""
    model.write().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cluster(df: DataFrame, key: str, features: Sequence[str] | None = None, k: int = 100, **how) -> DataFrame:
    """``(key, prediction)`` of :func:`fit_clusters`."""
    return fit_clusters(df, key, features, k, **how).assigned.select(key, "prediction")


def squared_distance(scaled: Column, centre: Sequence[float]) -> Column:
    """Squared Euclidean distance of a feature array to a fixed centre."""
    gaps = F.zip_with(scaled, F.array(*[F.lit(float(x)) for x in centre]), lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)


def at_nearest_centre(found: Clustering, slack: float = 1e-9) -> Column:
    """Whether an entity of ``found.assigned`` sits at a centre no other centre
    is nearer than (an audit that does not use the model's own assignment)."""
    distances = F.array(*[squared_distance(F.col("scaled"), c) for c in found.centres])
    own = F.get(distances, F.col("prediction"))
    return own <= F.array_min(distances) * (1 + slack) + slack
