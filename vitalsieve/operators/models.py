"""Classifier families on MLlib, with the parameters a user of the usual Python estimators knows."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.functions.columns import col
from vitalsieve.operators.features import BalancedWeights
from vitalsieve.operators.metrics import all_metrics
from vitalsieve.operators.splits import stratified_folds


class _Penalised(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Common part of the linear families: ``C`` is the inverse penalty for a sum of losses over the training rows."""

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    def _penalty(self, dataset: DataFrame) -> float:
        weight = F.sum(col(self.getWeightCol())) if self.isSet("weightCol") else F.count(F.lit(1))
        return 1.0 / (self.getOrDefault("C") * dataset.agg(weight.cast("double")).first()[0])

    def _weighted(self, inner):
        return inner.setWeightCol(self.getWeightCol()) if self.isSet("weightCol") else inner


class InverseLogistic(_Penalised):
    """Logistic regression with ``C`` and an ``l1`` or ``l2`` penalty; the intercept is not penalised."""

    penalty = Param(Params._dummy(), "penalty", "l1 or l2", TypeConverters.toString)

    def __init__(self, C: float = 1.0, penalty: str = "l2", weightCol: str | None = None, maxIter: int = 1000):
        super().__init__()
        self._set(C=float(C), penalty=penalty, maxIter=maxIter)
        if weightCol:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame):
        inner = LogisticRegression(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), regParam=self._penalty(dataset),
            elasticNetParam=1.0 if self.getOrDefault("penalty") == "l1" else 0.0, standardization=False,
            maxIter=self.getOrDefault("maxIter"), tol=1e-8, family="binomial",
        )
        return self._weighted(inner).fit(dataset)


class InverseLinearSvm(_Penalised):
    """Linear support vector machine with ``C``. Gives margins; wrap in ``SigmoidCalibrated`` for probabilities."""

    def __init__(self, C: float = 1.0, weightCol: str | None = None, maxIter: int = 100):
        super().__init__()
        self._set(C=float(C), maxIter=maxIter)
        if weightCol:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame):
        inner = LinearSVC(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), regParam=self._penalty(dataset),
            standardization=False, maxIter=self.getOrDefault("maxIter"), tol=1e-6,
        )
        return self._weighted(inner).fit(dataset)


class FourierFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features whose inner products approximate the kernel exp(-gamma |x - y|^2)."""

    gamma = Param(Params._dummy(), "gamma", "scale, auto or a number", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of cosine features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, gamma: str | float = "scale", size: int = 256, seed: int = 42):
        super().__init__()
        self._set(gamma=str(gamma), size=size, seed=seed)

    def _fit(self, dataset: DataFrame) -> "FourierFeaturesModel":
        stats = dataset.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")).first()["s"]
        mean, n = stats["mean"].toArray(), stats["count"]
        variance = stats["variance"].toArray() * (n - 1) / n
        width = len(mean)
        spread = float((variance + mean**2).mean() - mean.mean() ** 2)
        named = {"auto": 1.0 / width, "scale": 1.0 / (width * spread) if spread > 0 else 1.0}
        wanted = self.getOrDefault("gamma")
        gamma = named[wanted] if wanted in named else float(wanted)
        return FourierFeaturesModel(gamma, width, self.getOrDefault("size"), self.getOrDefault("seed"))


class FourierFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "input size", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "number of cosine features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, gamma: float = 1.0, width: int = 1, size: int = 256, seed: int = 42):
        super().__init__()
        self._set(gamma=float(gamma), width=width, size=size, seed=seed)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        draw = np.random.RandomState(self.getOrDefault("seed"))
        size = self.getOrDefault("size")
        weights = draw.normal(0.0, math.sqrt(2.0 * self.getOrDefault("gamma")), (self.getOrDefault("width"), size))
        shift = draw.uniform(0.0, 2.0 * math.pi, size)

        @F.pandas_udf("array<double>")
        def cosines(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(math.sqrt(2.0 / size) * np.cos(np.vstack(x.to_list()) @ weights + shift)))

        return dataset.withColumn("kernel_features", array_to_vector(cosines(vector_to_array("features"))))


class SigmoidCalibrated(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Probabilities for a margin classifier: a sigmoid fitted on out-of-fold margins, then the classifier on all rows."""

    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)

    def __init__(self, base: Estimator | None = None, keyCol: str = "row_id", folds: int = 5):
        super().__init__()
        self.base = base
        self._set(keyCol=keyCol, folds=folds)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        k = self.getOrDefault("folds")
        rows = stratified_folds(dataset, [self.getOrDefault("keyCol")], "label", k, out="_cal_fold").persist()
        margins = None
        for i in range(k):
            model = self.base.fit(rows.filter(F.col("_cal_fold") != i))
            part = model.transform(rows.filter(F.col("_cal_fold") == i)).select(
                vector_to_array("rawPrediction")[1].alias("margin"), F.col("label").cast("double").alias("label")
            )
            margins = part if margins is None else margins.unionByName(part)
        sizes = rows.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q")).first()
        high, low = (sizes.p + 1.0) / (sizes.p + 2.0), 1.0 / (sizes.q + 2.0)
        share = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
        soft = margins.select(
            array_to_vector(F.array("margin")).alias("features"),
            F.inline(F.array(
                F.struct(F.lit(1.0).alias("label"), share.alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (1.0 - share).alias("weight")),
            )),
        )
        link = LogisticRegression(weightCol="weight", standardization=False, maxIter=200, tol=1e-9).fit(soft)
        rows.unpersist()
        final = self.base.fit(dataset)
        return PipelineModel([final, SigmoidLink(float(link.coefficients[0]), float(link.intercept))])


class SigmoidLink(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    slope = Param(Params._dummy(), "slope", "slope", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "offset", TypeConverters.toFloat)

    def __init__(self, slope: float = 1.0, offset: float = 0.0):
        super().__init__()
        self._set(slope=slope, offset=offset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = vector_to_array("rawPrediction")[1]
        p = 1.0 / (1.0 + F.exp(-(F.lit(self.getOrDefault("slope")) * margin + F.lit(self.getOrDefault("offset")))))
        return (
            dataset.withColumn("_p", p)
            .withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p"))))
            .withColumn("prediction", (F.col("_p") > 0.5).cast("double"))
            .drop("_p")
        )


@dataclass(frozen=True)
class Family:
    """A classifier family: how to build its stages from parameters, and the grid searched for it."""

    name: str
    build: Callable[..., list]
    grid: Mapping[str, Sequence] | Sequence[Mapping[str, Sequence]] = field(default_factory=dict)
    fixed: Mapping[str, object] = field(default_factory=dict)

    def stages(self, **params) -> list:
        return self.build(**{**self.fixed, **params})

    def settings(self) -> list[dict]:
        """Every parameter combination of the grid."""
        grids = [self.grid] if isinstance(self.grid, Mapping) else list(self.grid)
        return [dict(zip(g, combo)) for g in grids for combo in product(*g.values())]


def _balanced(balanced: bool) -> tuple[list, str | None]:
    return ([BalancedWeights()], "weight") if balanced else ([], None)


def logistic(C: float = 1.0, penalty: str = "l2", balanced: bool = False) -> list:
    first, weight = _balanced(balanced)
    return [*first, InverseLogistic(C, penalty, weight)]


def support_vector(
    C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", balanced: bool = False, calibrated: bool = True,
    size: int = 256, seed: int = 42, key: str = "row_id", iterations: int = 100,
) -> list:
    """Linear margin classifier, on random cosine features for the ``rbf`` kernel (an approximation of that kernel)."""
    first, weight = _balanced(balanced)
    svm = InverseLinearSvm(C, weight, iterations)
    if kernel == "rbf":
        first = [*first, FourierFeatures(gamma, size, seed)]
        svm._set(featuresCol="kernel_features")
    return [*first, SigmoidCalibrated(svm, key) if calibrated else svm]


def forest(
    trees: int = 300, depth: int | None = None, leaf: int = 1, features: str = "sqrt", balanced: bool = False,
    bootstrap: bool = True, seed: int = 42, bins: int = 32,
) -> list:
    """Random forest. ``depth=None`` grows to MLlib's limit of 30 levels."""
    first, weight = _balanced(balanced)
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=30 if depth is None else depth, minInstancesPerNode=leaf, featureSubsetStrategy=features,
        bootstrap=bootstrap, seed=seed, maxBins=bins,
    )
    return [*first, model.setWeightCol(weight) if weight else model]


def forest_no_bootstrap(**params) -> list:
    """Trees on all rows with random feature subsets; split points are searched, not drawn."""
    return forest(**{**params, "bootstrap": False})


def boosted(
    trees: int = 100, rate: float = 0.1, depth: int | None = 3, share: float = 1.0, features: str = "all", leaf: int = 1,
    balanced: bool = False, seed: int = 42, bins: int = 32,
) -> list:
    """Gradient-boosted trees with logistic loss."""
    first, weight = _balanced(balanced)
    model = GBTClassifier(
        maxIter=trees, stepSize=rate, maxDepth=30 if depth is None else depth, subsamplingRate=share,
        featureSubsetStrategy=features, minInstancesPerNode=leaf, seed=seed, maxBins=bins,
    )
    return [*first, model.setWeightCol(weight) if weight else model]


# Candidate families and search grids per table.

_TREE_GRID = {"trees": [200, 400], "depth": [None, 5, 10], "leaf": [1, 2, 4]}
_BOOST_GRID = {"trees": [100, 200], "rate": [0.03, 0.1], "depth": [2, 3]}
_KERNEL_GRID = {"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto"], "kernel": ["rbf", "linear"]}


def general_families(balanced: bool = False, boosted_preset: bool = False) -> dict[str, Family]:
    """Candidates of the heart, diabetes and (``balanced``) stroke tables."""
    weight = {"balanced": True} if balanced else {}
    found = {
        "Logistic Regression": Family("Logistic Regression", logistic, {"C": [0.01, 0.1, 1.0, 10.0]}, weight),
        "SVM": Family("SVM", support_vector, _KERNEL_GRID, weight),
        "Random Forest": Family("Random Forest", forest, _TREE_GRID, {"trees": 300, **weight}),
        "Gradient Boosting": Family("Gradient Boosting", boosted, _BOOST_GRID),
    }
    if boosted_preset:
        preset = {"trees": 300, "rate": 0.05, "depth": 4, "share": 0.9, "features": "0.9"}
        found["XGBoost"] = Family("XGBoost", boosted, {}, preset)
    return found


def lung_families() -> dict[str, Family]:
    weight = {"balanced": True}
    return {
        "Logistic Regression": Family("Logistic Regression", logistic, {"C": [0.01, 0.1, 1.0, 10.0, 100.0]}, weight),
        "Support Vector Machine": Family(
            "Support Vector Machine", support_vector, {"C": [0.1, 1.0, 10.0, 100.0], "gamma": ["scale", 0.01, 0.1]}, weight
        ),
        "Random Forest": Family("Random Forest", forest, _TREE_GRID, weight),
        "Extra Trees": Family("Extra Trees", forest_no_bootstrap, _TREE_GRID, weight),
        "HistGradientBoosting": Family(
            "HistGradientBoosting", boosted,
            {"rate": [0.01, 0.05, 0.1], "trees": [100, 200], "depth": [3, 5, None], "leaf": [10, 20]}, {**weight, "bins": 255},
        ),
    }


def breast_families() -> dict[str, Family]:
    trees = {"trees": [100, 200], "depth": [None, 5, 10], "leaf": [1, 2], "features": ["sqrt", "log2"]}
    return {
        "Logistic Regression": Family(
            "Logistic Regression", logistic, {"penalty": ["l2", "l1"], "C": [0.01, 0.1, 1.0, 10.0]}
        ),
        "Support Vector Machine": Family(
            "Support Vector Machine", support_vector,
            [
                {"kernel": ["rbf"], "C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto", 0.01]},
                {"kernel": ["linear"], "C": [0.01, 0.1, 1.0, 10.0]},
            ],
        ),
        "Random Forest": Family("Random Forest", forest, trees),
        "Gradient Boosting": Family(
            "Gradient Boosting", boosted, {"trees": [100, 200], "rate": [0.01, 0.05, 0.1], "depth": [3, 4], "share": [0.8, 1.0]}
        ),
        "Extra Trees": Family("Extra Trees", forest_no_bootstrap, trees),
    }


def staged_families() -> dict[str, Family]:
    """Candidates of the asthma and parkinsons tables, where the best two go on to tuning."""
    weight = {"balanced": True}
    return {
        "logistic_regression": Family("logistic_regression", logistic, {"C": [0.1, 1.0, 10.0]}, weight),
        "svm": Family("svm", support_vector, _KERNEL_GRID, weight),
        "random_forest": Family("random_forest", forest, {"trees": [200, 400], "depth": [None, 8, 16], "leaf": [1, 2]}, {"trees": 300, **weight}),
        "gradient_boosting": Family("gradient_boosting", boosted, _BOOST_GRID),
    }


def positive_score(df: DataFrame) -> Column:
    """Positive-class probability if there is one, else the margin, else the predicted label."""
    if "probability" in df.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in df.columns:
        return vector_to_array("rawPrediction")[1]
    return F.col("prediction").cast("double")


def scored(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
    """Rows with ``score`` and an integer ``prediction``."""
    out = model.transform(df)
    return out.select(*[col(k) for k in keep], F.col("prediction").cast("int").alias("prediction"), positive_score(out).alias("score"))


class MetricEvaluator(Evaluator):
    """Any metric of ``all_metrics`` for Spark's own ``CrossValidator``."""

    def __init__(self, metric: str = "avg_precision", labelCol: str = "label"):
        super().__init__()
        self.metric, self.label = metric, labelCol

    def _evaluate(self, dataset: DataFrame) -> float:
        rows = dataset.select(
            col(self.label).alias("y"), F.col("prediction").alias("p"), positive_score(dataset).alias("s")
        )
        return float(all_metrics(rows, "y", "p", "s").first()[self.metric])

    def isLargerBetter(self) -> bool:
        return True


def pipeline(prep: Estimator, stages: Sequence) -> Pipeline:
    return Pipeline(stages=[prep, *stages])


def coefficients(model: PipelineModel, names: Sequence[str], spark) -> DataFrame:
    """(feature, coefficient) of a linear model, the intercept last."""
    inner = next(s for s in model.stages[::-1] if hasattr(s, "coefficients"))
    rows = [(n, float(c)) for n, c in zip(names, inner.coefficients.toArray())] + [("(intercept)", float(inner.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")
