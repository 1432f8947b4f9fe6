"""The score table: a run that was cut off goes on where it stopped, other rows never share parts, and models do not pile up."""

import gc
import weakref

import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from vitalsieve.operators import models
from vitalsieve.operators.features import TablePrep
from vitalsieve.plans import train
from vitalsieve.plans.scores import ScoreTable, row_version


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(120).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 2).cast("int").alias("fold"))


class Spy(Estimator):
    """Fits a small forest, counts its fits, and may break."""

    fits, alive, breaks = [], [], set()

    def __init__(self, name):
        super().__init__()
        self.name = name

    def _fit(self, dataset):
        Spy.fits.append(self.name)
        if self.name in Spy.breaks:
            raise RuntimeError("lost")
        model = models.forest(trees=1, depth=1)[0].fit(dataset)
        Spy.alive.append(weakref.ref(model))
        return model


def prep():
    return TablePrep([("x", "scale")])


CANDIDATES = {n: (lambda n=n: [Spy(n)]) for n in ("a", "b", "c")}


def test_a_run_cut_off_goes_on(spark, rows, tmp_path):
    path = str(tmp_path / "scores")
    Spy.fits, Spy.breaks = [], {"b"}
    with pytest.raises(Exception, match="lost"):
        train.cross_validate(rows, prep, CANDIDATES, 2, 1, path)
    there = len([x for x in Spy.fits if x != "b"])
    Spy.fits, Spy.breaks = [], set()
    measured = train.cross_validate(rows, prep, CANDIDATES, 2, 1, path)
    assert there > 0 and len(Spy.fits) == 6 - there and Spy.fits.count("b") == 2
    assert {(r.model, r.fold) for r in measured.select("model", "fold").collect()} == {(m, f) for m in "abc" for f in (0, 1)}
    Spy.fits = []
    again = train.cross_validate(rows, prep, CANDIDATES, 2, 1, path)
    assert Spy.fits == []
    key = ["model", "fold"]
    assert sorted(map(tuple, again.orderBy(key).collect())) == sorted(map(tuple, measured.orderBy(key).collect()))


def test_more_candidates_fit_only_themselves(spark, rows, tmp_path):
    path = str(tmp_path / "scores")
    train.cross_validate(rows, prep, {"a": CANDIDATES["a"]}, 2, 2, path)
    Spy.fits = []
    measured = train.cross_validate(rows, prep, {k: CANDIDATES[k] for k in "ab"}, 2, 2, path)
    assert sorted(Spy.fits) == ["b", "b"] and measured.count() == 4
    assert train.cross_validate(rows, prep, {"b": CANDIDATES["b"]}, 2, 2, path).count() == 2


def test_other_rows_or_settings_share_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "scores")
    train.cross_validate(rows, prep, {"a": CANDIDATES["a"]}, 2, 2, path)
    Spy.fits = []
    train.cross_validate(rows.withColumn("x", F.col("x") + 1), prep, {"a": CANDIDATES["a"]}, 2, 2, path)
    train.cross_validate(rows, prep, {"a": CANDIDATES["a"]}, 2, 2, path, settings="depth 2")
    assert len(Spy.fits) == 4


def test_a_part_without_an_entry_is_written_over(spark, rows, tmp_path):
    store = ScoreTable(spark, str(tmp_path / "scores"), "v")
    one = rows.select("label", F.lit(1).alias("prediction"), F.lit(0.5).alias("score"))
    one.write.parquet(store._part("a", 0))
    assert store.committed() == set()
    store.commit(one.limit(3), "a", 0)
    assert store.committed() == {("a", 0)} and store.scores().count() == 3
    with pytest.raises(ValueError, match="no scores"):
        ScoreTable(spark, str(tmp_path / "scores"), "w").scores()


def test_models_live_until_their_scores_are_committed(spark, rows, tmp_path):
    Spy.alive = []
    train.cross_validate(rows, prep, CANDIDATES, 2, 1, str(tmp_path / "scores"))
    gc.collect()
    assert len(Spy.alive) == 6 and sum(r() is not None for r in Spy.alive) <= 1


def test_version_of_rows(spark, rows):
    assert row_version(rows) == row_version(rows.repartition(5).sort(F.desc("row_id")))
    assert row_version(rows) != row_version(rows.unionByName(rows.limit(1)))
    assert row_version(rows.limit(0)) == row_version(rows.limit(0))
