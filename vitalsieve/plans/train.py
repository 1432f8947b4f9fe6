"""Cross-validation, tuning, selection and held-out evaluation."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from uuid import uuid4

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from vitalsieve.contracts import TableContract
from vitalsieve.operators.features import TablePrep
from vitalsieve.operators.metrics import all_metrics, champion, fold_summary
from vitalsieve.operators.models import Family, scored
from vitalsieve.operators.splits import group_folds, stratified_folds, with_group_folds
from vitalsieve.plans.scores import ScoreTable, row_version
from vitalsieve.session import checkpoint_dir, checkpointed

Stages = Callable[[], list]

# Iterative fits start a job per step. Below this many rows in a partition, starting tasks costs more than running them.
ROWS_PER_PARTITION = 20_000


def with_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, group: str | None = None) -> DataFrame:
    """Add ``fold``; with a group, no group is cut."""
    if group:
        return with_group_folds(df, group_folds(df, group, "label", 1, k, seed), group)
    return stratified_folds(df, [key], "label", k, seed)


def score_folds(
    df: DataFrame, prep: Callable[[], TablePrep], candidates: Mapping[str, Stages], store: ScoreTable, k: int = 5, parallelism: int = 4,
    keep: Sequence[str] = ("label",),
) -> DataFrame:
    """Held-out scores per (model, fold), with the columns of ``keep``, in ``store``.

    The preparation is fitted on the training rows of each fold, once for all candidates, and the prepared rows are kept for
    their fits, which run side by side. A model lives until its scores are committed: at most ``parallelism`` at a time, however
    large the grid. A run that starts again fits what is missing only; a fold without gaps is not prepared.
    """
    done = store.committed()
    missing = {fold: [name for name in candidates if (name, fold) not in done] for fold in range(k)}
    if any(missing.values()):
        rows = df.persist()
        partitions = 1 + rows.count() // ROWS_PER_PARTITION
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for fold, names in missing.items():
                if names:
                    fitted = prep().fit(rows.filter(F.col("fold") != fold))
                    train = fitted.transform(rows.filter(F.col("fold") != fold)).coalesce(partitions).persist()
                    test = fitted.transform(rows.filter(F.col("fold") == fold)).coalesce(partitions)

                    def one(name: str) -> None:
                        store.commit(scored(Pipeline(stages=candidates[name]()).fit(train), test, keep), name, fold)

                    list(pool.map(one, names))
                    train.unpersist()
        rows.unpersist()
    return store.scores().filter(F.col("model").isin(*candidates))


def score_store(df: DataFrame, path: str | None = None, settings: str = "") -> ScoreTable:
    """The score table of these rows and settings: below ``path``, or in the shared folder for this run alone."""
    home = path or f"{checkpoint_dir(df.sparkSession).rstrip('/')}/scores-{uuid4().hex}"
    return ScoreTable(df.sparkSession, home, f"{row_version(df)} {settings}" if path else "")


def cross_validate(
    df: DataFrame, prep: Callable[[], TablePrep], candidates: Mapping[str, Stages], k: int = 5, parallelism: int = 4,
    path: str | None = None, settings: str = "",
) -> DataFrame:
    """Metrics per (model, fold), all measured together in two aggregations over the stored scores.

    With ``path`` the scores stay there, and a later run over equal rows and ``settings`` goes on from them.
    """
    held_out = score_folds(df, prep, candidates, score_store(df, path, settings), k, parallelism)
    return all_metrics(held_out, "label", "prediction", "score", ["model", "fold"])


def _fixed(families: Mapping[str, Family]) -> str:
    return json.dumps({name: [f.build.__name__, dict(f.fixed)] for name, f in families.items()}, sort_keys=True, default=str)


def compare_models(
    df: DataFrame, families: Mapping[str, Family], prep: Callable[[], TablePrep], k: int = 5, parallelism: int = 4, path: str | None = None
) -> DataFrame:
    """Mean and deviation of every metric per family, with the family's fixed settings."""
    candidates = {name: f.stages for name, f in families.items()}
    return fold_summary(cross_validate(df, prep, candidates, k, parallelism, path, _fixed(families)))


def tune(
    df: DataFrame, families: Mapping[str, Family], prep: Callable[[], TablePrep], metric: str = "roc_auc", k: int = 5, parallelism: int = 4,
    path: str | None = None,
) -> DataFrame:
    """Search every family's grid: one row per family with its best setting and all its mean metrics.

    Every setting of every family is one candidate of a single cross-validation.
    """
    candidates, names = {}, {}
    for name, family in families.items():
        for params in family.settings() or [{}]:
            text = json.dumps(params, sort_keys=True)
            candidates[f"{name} {text}"] = partial(family.stages, **params)
            names[f"{name} {text}"] = (name, text)
    summary = fold_summary(cross_validate(df, prep, candidates, k, parallelism, path, _fixed(families)))
    lookup = df.sparkSession.createDataFrame([(key, *v) for key, v in names.items()], "model string, family string, best_parameters string")
    ranked = summary.join(F.broadcast(lookup), "model")
    best = ranked.groupBy("family").agg(
        F.max_by(F.struct(*[F.col(c) for c in ranked.columns if c != "family"]), F.struct(F.col(f"{metric}_mean"), F.col("model"))).alias("r")
    )
    return best.select("family", "r.*").drop("model").withColumnRenamed("family", "model")


@dataclass(frozen=True)
class Trained:
    name: str
    params: dict
    model: PipelineModel
    comparison: DataFrame
    test_metrics: DataFrame


def evaluate_candidates(train: DataFrame, test: DataFrame, candidates: Mapping[str, Stages]) -> DataFrame:
    """Fit each candidate on the training rows and measure all of them once on the held-out rows."""
    parts = [
        scored(Pipeline(stages=stages()).fit(train), test).withColumn("model", F.lit(name)) for name, stages in candidates.items()
    ]
    return all_metrics(reduce(DataFrame.unionByName, parts), "label", "prediction", "score", ["model"])


def train_best(
    train: DataFrame, test: DataFrame, contract: TableContract, families: Mapping[str, Family], k: int = 5, seed: int = 42,
    metric: str = "roc_auc", staged: int | None = None, parallelism: int = 4, method: str = "select", group: str | None = None,
) -> Trained:
    """Tune on the training rows, pick the champion, refit it on all of them, evaluate once on the held-out rows.

    ``staged`` first compares all families with default settings and tunes only the best so many.
    """
    def prep() -> TablePrep:
        return TablePrep.for_contract(contract, method)

    folded = with_folds(train, contract.row_id, k, seed, group or contract.group)
    pool = dict(families)
    if staged:
        leaders = champion(compare_models(folded, pool, prep, k, parallelism), top=staged).select("model").collect()
        pool = {r.model: pool[r.model] for r in leaders}
    comparison = checkpointed(tune(folded, pool, prep, metric, k, parallelism))
    order = [f"{metric}_mean", *[m for m in ("roc_auc_mean", "avg_precision_mean", "balanced_accuracy_mean", "specificity_mean") if m != f"{metric}_mean"]]
    top = champion(comparison, order).first()
    params = json.loads(top["best_parameters"])
    model = Pipeline(stages=[prep(), *pool[top["model"]].stages(**params)]).fit(train)
    test_metrics = all_metrics(scored(model, test), "label", "prediction", "score")
    return Trained(top["model"], params, model, comparison, test_metrics)


def fit_release(rows: DataFrame, contract: TableContract, family: Family, params: Mapping[str, object] | None = None, method: str = "select") -> PipelineModel:
    """Fit the released model on the rows given, which may include the held-out part."""
    return Pipeline(stages=[TablePrep.for_contract(contract, method), *family.stages(**(params or {}))]).fit(rows)
