"""The searches and experiments at their stated size."""

import random

import pytest
from pyspark.sql import functions as F

from barloom.catalog import QUERIES
from barloom.learning import extra_trees, research
from barloom.operators.features import RESEARCH_FEATURES


@pytest.fixture
def asked(monkeypatch):
    """What the registered queries ask for, without the fits."""
    from barloom.catalog import learning

    calls = {}
    monkeypatch.setattr(learning, "periods", lambda spark, sf, name="training": ((name, "train"), (name, "test")))
    monkeypatch.setattr(learning.model, "narrowed", lambda rows, names: rows)
    monkeypatch.setattr(learning, "_ranked", lambda train: train)
    monkeypatch.setattr(research, "top_features", lambda ranked, n=30: [f"f{k}" for k in range(n)])

    def search(train, features, n=research.SEARCH_DRAWS, folds=research.SEARCH_FOLDS, space=None, **_):
        calls.update(table=train[0], features=len(features), settings=len(research.draws(n, space=space)), folds=folds, space=space)

    def experiment(train, test, ranked, counts=research.FEATURE_COUNTS, setting=extra_trees.EXPERIMENT):
        calls.update(table=train[0], counts=[len(ranked), *counts], setting=setting)

    monkeypatch.setattr(research, "random_search", search)
    monkeypatch.setattr(research, "feature_count_experiment", experiment)
    monkeypatch.setattr(research, "compare_models", lambda train, test, features: calls.update(table=train[0], features=len(features)))
    return lambda name: (QUERIES[name](None, ""), dict(calls))[1]


def test_queries_ask_for_the_whole_job(asked):
    assert asked("parameter_search") == {"table": "research", "features": 65, "settings": 20, "folds": 5, "space": None}
    assert asked("parameter_tuning") | {"space": 0} == {"table": "research", "features": 65, "settings": 100, "folds": 5, "space": 0}
    got = asked("feature_count_experiment")
    assert got["counts"] == [65, 40, 30, 23, 20, 15, 10] and (got["setting"].trees, got["setting"].max_depth, got["setting"].max_leaves) == (500, 6, 31) and got["table"] == "research"
    assert asked("model_comparison")["features"] == len(RESEARCH_FEATURES) == 65


def test_a_small_space_is_refused(spark):
    rows = spark.createDataFrame([(0.0, 0), (1.0, 1)], "x double, target int")
    with pytest.raises(ValueError, match="216"):
        research.random_search(rows, ["x"], n=217)


def test_search_equals_forests_grown_one_by_one(spark):
    pick = random.Random(5)
    data = [(k, pick.gauss(0, 1), pick.random(), pick.randint(0, 3) / 1.0) for k in range(500)]
    rows = spark.createDataFrame([(*r, int(r[1] + r[3] / 2 + pick.gauss(0, 0.6) > 1.2)) for r in data], "id long, a double, b double, c double, target int").persist()
    space = {"trees": [3, 5], "max_depth": [2, 4, None], "min_split": [2, 30], "min_leaf": [1, 8], "max_features": ["sqrt", "all"]}
    got = research.random_search(rows, ["a", "b", "c"], n=6, folds=3, space=space, keys=["id"]).collect()
    assert len(got) == 6 and [r["precision"] for r in got] == sorted((r["precision"] for r in got), reverse=True)
    folded = rows.withColumn("f", F.pmod(F.xxhash64("id", F.lit(research.SEED)), F.lit(3)).cast("int")).persist()
    found = {tuple(r)[:-1]: r["precision"] for r in got}
    for choice in research.draws(6, space=space):
        setting, each = extra_trees.Setting(**choice), []
        for fold, forest in enumerate(extra_trees.grow(folded, ["a", "b", "c"], [setting] * 3, fold="f", left_out=[0, 1, 2])):
            said = extra_trees.predict(forest, folded.filter(F.col("f") == fold)).filter("Prediction = 1").agg(F.avg("target")).first()[0]
            each.append(said or 0.0)
        assert found[tuple(str(v) for v in choice.values())] == pytest.approx(sum(each) / 3)
    assert len(extra_trees.widest([extra_trees.Setting(**c) for c in research.draws(6, space=space)])) <= 4


def test_boosting_runs_all_rounds(spark):
    assert research.candidates()["gradient_boosting"].getMaxIter() == 100


def test_contribution_sample_is_chosen_once(spark):
    from barloom.learning import model

    pick = random.Random(3)
    rows = [(f"S{k}", k, pick.random(), pick.random(), k % 2) for k in range(60)]
    frame = spark.createDataFrame(rows, "Ticker string, Date int, a double, b double, target int").repartition(3)
    fitted, read = model.fit(frame, ["a", "b"], model.forest(numTrees=3, maxDepth=2)), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    out = research.mean_contribution(fitted, frame.mapInArrow(counted, frame.schema), ["a", "b"], n=20).collect()
    assert sorted(r["feature"] for r in out) == ["a", "b"]
    assert read.value == len(rows)
