"""Feature preparation: fitted on training rows, applied to any rows.

Fitting reads the table with a fixed number of aggregates. What it keeps is small (one number per column, one text per
category level), so applying it is a projection without a join.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from itertools import groupby
from uuid import uuid4

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from vitalsieve.contracts import TableContract
from vitalsieve.functions.columns import col, quoted, tall
from vitalsieve.operators.levels import level_dictionary, read_dictionary, slots, with_level_index
from vitalsieve.operators.quantiles import quantiles
from vitalsieve.session import checkpoint_dir, checkpointed, small_side

#: Levels of a column that are kept as texts in the fitted model; a column with more has a dictionary as a table.
MAX_LEVELS = 10_000


def numeric_statistics(df: DataFrame, columns: Sequence[str], method: str = "select") -> DataFrame:
    """(feature, median, mean, scale): mean and population deviation after filling gaps with the median.

    The filled moments follow from the moments of the present values, so the table is not read again after the median.
    """
    medians = quantiles(df, columns, [0.5], method=method).select("feature", F.col("value").alias("median"))
    present = tall(df, columns).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_present"), F.avg("value").alias("avg"), F.var_pop("value").alias("var")
    )
    n, k, gap = F.col("n"), F.col("n_present"), F.col("n") - F.col("n_present")
    mean = (F.col("avg") * k + F.col("median") * gap) / n
    spread = (F.col("var") * k + F.pow(F.col("avg") - F.col("median"), 2) * k * gap / n) / n
    scale = F.when(spread > 0, F.sqrt(spread)).otherwise(F.lit(1.0))
    return present.join(F.broadcast(medians), "feature", "left").select("feature", "median", mean.alias("mean"), scale.alias("scale"))


def category_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, n, is_mode): levels of each column; the mode is the most frequent, smallest on ties."""
    kinds = dict(df.dtypes)
    counts = (
        tall(df, columns, as_type="string").filter(F.col("value").isNotNull())
        .groupBy("feature", F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    )
    numbers = [c for c in columns if kinds[c] != "string"]
    order = F.when(F.col("feature").isin(*numbers, ""), F.col("level").try_cast("double"))
    best = counts.groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("n"), order.alias("o"), F.col("level"))).alias("best")
    )
    return counts.join(F.broadcast(best), "feature").select("feature", "level", "n", (F.col("level") == F.col("best.level")).alias("is_mode"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): n / (classes * n of the class)."""
    counts = df.filter(col(label).isNotNull()).groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy(F.lit(1))  # one row per class
    return counts.select(
        "label", "n", (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = small_side(class_weights(df, label).select(F.col("label").alias("_l"), F.col("weight").alias(out)))
    return df.join(weights, col(label) == F.col("_l"), "left").drop("_l")


class _PrepParams(Params):
    plan = Param(Params._dummy(), "plan", "JSON list of [column, scale|fill|pass|levels]", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)
    method = Param(Params._dummy(), "method", "quantile method of the medians", TypeConverters.toString)
    dictionaries = Param(Params._dummy(), "dictionaries", "folder of level dictionaries; empty: the shared scratch folder", TypeConverters.toString)


class TablePrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, scale and encode. Columns are treated in plan order; columns outside the plan do not enter the vector.

    ``scale``: median for gaps, then (x - mean) / population deviation, deviation 0 divides by 1. ``fill``: median
    only. ``pass``: as is. ``levels``: most frequent level for gaps, then one 0/1 slot per level seen in training;
    other levels give zeros. Columns with more than ``MAX_LEVELS`` levels have the same slots, in a sparse vector, from a dictionary
    that stays a table: name a lasting folder in ``dictionaries`` when the fitted model is to be saved.
    """

    def __init__(self, plan: Sequence[tuple[str, str]] = (), outputCol: str = "features", method: str = "select", dictionaries: str = ""):
        super().__init__()
        self._setDefault(outputCol="features", method="select", dictionaries="")
        self._set(plan=json.dumps([list(p) for p in plan]), outputCol=outputCol, method=method, dictionaries=dictionaries)

    @classmethod
    def for_contract(cls, contract: TableContract, method: str = "select") -> "TablePrep":
        scaled, levels = set(contract.scaled_columns), set(contract.categorical)
        plan = [(c, "levels" if c in levels else "scale" if c in scaled else "pass") for c in contract.features]
        return cls(plan, method=method)

    def _fit(self, dataset: DataFrame) -> "TablePrepModel":
        plan = json.loads(self.getOrDefault("plan"))
        filled = [c for c, how in plan if how in ("scale", "fill")]
        leveled = [c for c, how in plan if how == "levels"]
        numbers, levels = {}, {}
        if filled:
            for r in numeric_statistics(dataset, filled, self.getOrDefault("method")).collect():
                numbers[r.feature] = [r.median, r.mean, r.scale]
        if leveled:
            kinds = {f.name: f.dataType for f in dataset.schema.fields}
            numeric = [c for c in leveled if isinstance(kinds[c], T.NumericType)]
            counts = category_levels(dataset, leveled)
            rows = counts.limit(MAX_LEVELS + 1).collect()
            if len(rows) > MAX_LEVELS:
                counts, levels = self._dictionary(counts, numeric)
                rows = counts.collect()  # of columns with at most MAX_LEVELS
            for c in leveled:
                if c in levels:
                    continue
                mine = [r for r in rows if r.feature == c]
                mine.sort(key=lambda r: (float(r.level), r.level) if c in numeric else r.level)
                levels[c] = {"levels": [r.level for r in mine], "mode": next((r.level for r in mine if r.is_mode), None)}
        steps = []
        for c, how in plan:
            if how == "pass":
                steps.append({"column": c, "how": how})
            elif how == "levels":
                steps.append({"column": c, "how": "dictionary" if "path" in levels[c] else how, **levels[c]})
            else:
                median, mean, scale = numbers.get(c, [None] * 3)
                if median is None:
                    warnings.warn(f"column '{c}' has no values in the training rows and is left out")
                    continue
                steps.append({"column": c, "how": how, "median": median, "mean": mean, "scale": scale})
        return TablePrepModel(steps, self.getOrDefault("outputCol"))

    def _dictionary(self, counts: DataFrame, numeric: Sequence[str]) -> tuple[DataFrame, dict]:
        """The counts of columns with few levels, and where the dictionaries of the others are. The driver sees a row per column."""
        home = self.getOrDefault("dictionaries") or checkpoint_dir(counts.sparkSession)
        path = f"{home.rstrip('/')}/levels-{uuid4().hex}"
        held = checkpointed(counts)
        sizes = held.groupBy("feature").agg(F.count(F.lit(1)).alias("size"), F.max(F.when(F.col("is_mode"), F.col("level"))).alias("mode")).collect()
        many = {r.feature: {"path": path, "size": r.size, "mode": r.mode} for r in sizes if r.size > MAX_LEVELS}
        if many:
            level_dictionary(held.filter(F.col("feature").isin(*many)), [c for c in numeric if c in many], path)
        return held.filter(~F.col("feature").isin(*many, "")), many


class TablePrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    steps = Param(Params._dummy(), "steps", "JSON of the fitted steps", TypeConverters.toString)

    def __init__(self, steps: list[dict] | None = None, outputCol: str = "features"):
        super().__init__()
        self._set(steps=json.dumps(steps or []), outputCol=outputCol)

    def fitted(self) -> list[dict]:
        return json.loads(self.getOrDefault("steps"))

    def columns(self, steps: list[dict] | None = None) -> list[Column]:
        """One named double column per output feature of the steps; those with a dictionary have none."""
        out = []
        for s in self.fitted() if steps is None else steps:
            name, how = s["column"], s["how"]
            value = col(name)
            if how == "dictionary":
                continue
            if how == "pass":
                out.append(value.cast("double").alias(name))
            elif how == "levels":
                text = F.coalesce(value.cast("string"), F.lit(s["mode"]))
                out += [(text == F.lit(v)).cast("double").alias(f"{name}_{v}") for v in s["levels"]]
            else:
                number = F.coalesce(value.cast("double"), F.lit(s["median"]))
                if how == "scale":
                    number = (number - F.lit(s["mean"])) / F.lit(s["scale"])
                out.append(number.alias(name))
        return out

    def feature_names(self) -> list[str]:
        names = []
        for s in self.fitted():
            if s["how"] == "dictionary":
                names += [f"{s['column']}#{i}" for i in range(s["size"])]
            else:
                names += [f"{s['column']}_{v}" for v in s["levels"]] if s["how"] == "levels" else [s["column"]]
        return names

    def statistics(self, spark) -> DataFrame:
        """Fitted numbers as a tall table (feature, stat, value)."""
        rows = [
            (s["column"], stat, float(s[stat]))
            for s in self.fitted() if s["how"] in ("scale", "fill") for stat in ("median", "mean", "scale")
        ]
        return spark.createDataFrame(rows, "feature string, stat string, value double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        steps, out = self.fitted(), self.getOrDefault("outputCol")
        if all(s["how"] != "dictionary" for s in steps):
            return dataset.withColumn(out, array_to_vector(F.array(*self.columns())))
        rows, pieces = dataset, []
        for many, run in groupby(steps, key=lambda s: s["how"] == "dictionary"):
            if not many:
                pieces.append(f"_piece{len(pieces)}")
                rows = rows.withColumn(pieces[-1], array_to_vector(F.array(*self.columns(list(run)))))
                continue
            for s in run:
                pieces.append(f"_piece{len(pieces)}")
                table = read_dictionary(rows.sparkSession, s["path"])
                rows = slots(with_level_index(rows, s["column"], table, s["size"], s["mode"], "_index"), "_index", s["size"], pieces[-1]).drop("_index")
        return VectorAssembler(inputCols=pieces, outputCol=out).transform(rows).drop(*pieces)


class BalancedWeights(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Class weights of the rows it is fitted on; inside a pipeline they are recomputed for every training fold."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column", TypeConverters.toString)

    def __init__(self, labelCol: str = "label", weightCol: str = "weight"):
        super().__init__()
        self._set(labelCol=labelCol, weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> "BalancedWeightsModel":
        rows = class_weights(dataset, self.getOrDefault("labelCol")).limit(MAX_LEVELS + 1).collect()
        if len(rows) > MAX_LEVELS:
            raise ValueError(f"more than {MAX_LEVELS} labels: join the weights with with_class_weights instead")
        table = {str(float(r.label)): r.weight for r in rows}
        return BalancedWeightsModel(self.getOrDefault("labelCol"), self.getOrDefault("weightCol"), json.dumps(table))


class BalancedWeightsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "JSON label -> weight", TypeConverters.toString)

    def __init__(self, labelCol: str = "label", weightCol: str = "weight", table: str = "{}"):
        super().__init__()
        self._set(labelCol=labelCol, weightCol=weightCol, table=table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = self.getOrDefault("labelCol")
        if label not in dataset.columns:
            return dataset
        weights = json.loads(self.getOrDefault("table"))
        pick = F.lit(None).cast("double")
        for value, weight in weights.items():
            pick = F.when(col(label).cast("double") == float(value), F.lit(weight)).otherwise(pick)
        return dataset.withColumn(self.getOrDefault("weightCol"), pick)


def select_features(df: DataFrame, contract: TableContract, key: str | None = None) -> DataFrame:
    """Features in contract order with the label; the key is kept if named."""
    keys = [quoted(key)] if key else []
    return df.select(*keys, *map(quoted, contract.features), "label")
