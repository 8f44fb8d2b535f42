"""Forests and linear models, fitted by MLlib on the partitioned feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.columns import LABEL
from shelfcast.functions.values import clip_nonnegative

KEYS = ("id", "date", "store_id", "dept_id")
# Forests of up to so many rows times trees keep each row's node in each tree, four bytes each.
NODES_KEPT = 250_000_000


def feature_columns(df: DataFrame, skip: Sequence[str] = (LABEL, *KEYS)) -> list[str]:
    """Numeric columns that are neither key nor label."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature vector beside the keys; a training row missing a feature is skipped."""
    ready = df.na.drop(subset=list(columns))
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(ready)


def assemble_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature vectors of rows that all need a prediction: a missing feature is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error").transform(df)


def fill_from_training(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing features as the training mean, so that every horizon row gets a prediction.

    Short lags reach into the horizon and are missing on its later days. Boosted trees keep
    them missing; MLlib's learners do not take any. A column without any training value stays
    missing, and ``predict`` then fails.
    """
    means = train.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return df.fillna({c: m for c, m in means.items() if m is not None})


def predict(model: Model, df: DataFrame, columns: Sequence[str], name: str = "pred") -> DataFrame:
    """Predictions beside the keys, one for every row, negatives clipped to 0."""
    # A pipeline makes its own vectors.
    scored = model.transform(df if isinstance(model, PipelineModel) else assemble_all(df, columns))
    keys = [k for k in KEYS if k in df.columns]
    return scored.select(*keys, clip_nonnegative(F.col("prediction")).alias(name))


def fit_forest(
    train: DataFrame, columns: Sequence[str], trees: int = 1000, depth: int = 10, share: str = "onethird", seed: int = 42
) -> Model:
    """Random forest; ``share`` is the part of the columns tried at a split.

    Many trees of few rows keep where each row is in each tree, instead of walking down every tree
    from its root at every pass. Trees are the same; with many rows the nodes would take the memory
    that the rows need.
    """
    forest = RandomForestRegressor(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, featureSubsetStrategy=share, seed=seed,
        cacheNodeIds=train.count() * trees <= NODES_KEPT,
    )
    return forest.fit(assemble(train.filter(F.col(LABEL).isNotNull()), columns))


def _fit_linear(glm: GeneralizedLinearRegression, train: DataFrame, columns: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """A linear model whose ``categorical`` columns become sparse indicators, one a code and one for codes not seen.

    Every iteration reads the rows again, so their vectors are kept for the fit.
    """
    known = train.filter(F.col(LABEL).isNotNull()).na.drop(subset=list(columns))
    plain = [c for c in columns if c not in categorical]
    hot = [f"{c}_hot" for c in categorical]
    stages = [VectorAssembler(inputCols=[*plain, *hot], outputCol="features", handleInvalid="error")]
    if categorical:
        stages.insert(0, OneHotEncoder(inputCols=list(categorical), outputCols=hot, handleInvalid="keep", dropLast=False))
    ready_model = Pipeline(stages=stages).fit(known)
    ready = ready_model.transform(known).select(LABEL, "features")
    ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*ready_model.stages, glm.fit(ready)])
    finally:
        ready.unpersist()


def fit_poisson(train: DataFrame, columns: Sequence[str], categorical: Sequence[str] = ()) -> PipelineModel:
    glm = GeneralizedLinearRegression(labelCol=LABEL, family="poisson", link="log", maxIter=25, regParam=0.01)
    return _fit_linear(glm, train, columns, categorical)


def fit_tweedie(train: DataFrame, columns: Sequence[str], categorical: Sequence[str] = (), power: float = 1.1) -> PipelineModel:
    glm = GeneralizedLinearRegression(
        labelCol=LABEL, family="tweedie", variancePower=power, linkPower=0.0, maxIter=25, regParam=0.01
    )
    return _fit_linear(glm, train, columns, categorical)


def importances(model: Model, columns: Sequence[str], train: DataFrame) -> DataFrame:
    """Impurity importance per feature, largest first."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
