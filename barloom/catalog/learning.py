"""Training, evaluation and scoring over all bars.

Models are fitted on the features with the index carried forward (the index misses one day a
month, so no 60-row frame would be complete without it).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.catalog import features as _features  # noqa: F401  (its statements are used below)
from barloom.catalog.registry import ORACLES, over, query, rounded
from barloom.catalog.tables import stored
from barloom.learning import balance, evaluation, extra_trees, model, research
from barloom.operators import label
from barloom.operators.features import RESEARCH_FEATURES, SERVING_FEATURES, feature_frame, features, panel_of_bars
from barloom.operators.profile import repeatable_sample
from barloom.session import shared_dir
from barloom.sources import tables

SPLIT = dt.date(2000, 6, 1)


def training_frame(spark: SparkSession, sf: str, names: Sequence[str] = SERVING_FEATURES) -> DataFrame:
    bars = stored(spark, sf, "bars")
    panel = features(panel_of_bars(bars, stored(spark, sf, "market"), fill_market=True), names)
    rows = label.with_target(panel).result()
    return label.training_rows(rows.select("Date", "Ticker", *label.RAW_COLUMNS, *names, "target"))


def periods(spark: SparkSession, sf: str, name: str = "training") -> tuple[DataFrame, DataFrame]:
    """Both periods of the training rows as a written table: fits read them many times."""
    return label.split_by_day(stored(spark, sf, name), SPLIT, purge=label.HORIZON)


@query("M-01 M-02 M-04 M-05 M-06 A-15 A-16")
def train_and_report(spark, sf):
    """Fit the final model before the split day and report on both periods."""
    train, test = periods(spark, sf)
    fitted = model.fit(train, SERVING_FEATURES)
    out = None
    for name, frame in (("train", train), ("test", test)):
        one = evaluation.report(evaluation.confusion(model.predict(fitted, frame))).select(F.lit(name).alias("period"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("M-03 A-15")
def candidate_model_confusion(spark, sf):
    train, test = periods(spark, sf)
    fitted = model.fit(train, SERVING_FEATURES, model.forest(**model.CANDIDATE))
    return evaluation.confusion(model.predict(fitted, test))


@query("M-07 S-11 K-07 A-01 J-05 Q-03")
def score_latest_rows(spark, sf):
    """Fit, store, load, and score the last row of every series."""
    fitted = model.fit(stored(spark, sf, "training"), SERVING_FEATURES)
    path = shared_dir(spark, "model")
    model.save(fitted, path)
    bars = stored(spark, sf, "bars")
    rows = feature_frame(bars, stored(spark, sf, "market"), SERVING_FEATURES, fill_market=True)
    return model.score_latest(model.load(path), rows, SERVING_FEATURES)


@query("M-08")
def model_comparison(spark, sf):
    """Five classifiers on all candidate features, the smaller class of the training rows filled up with new rows."""
    train, test = periods(spark, sf, "research")
    return research.compare_models(train, test, RESEARCH_FEATURES)


@query("M-08", f"""
SELECT CAST(c AS INTEGER) AS target, GREATEST(ones, n - ones)::BIGINT AS n_rows, (GREATEST(ones, n - ones) - IF(c = 1, ones, n - ones))::BIGINT AS n_new,
  0::BIGINT AS off_segment, 0::BIGINT AS unknown_ends
FROM (VALUES (0), (1)) v(c), (SELECT COUNT(*) AS n, SUM(target) AS ones FROM ({ORACLES['training_rows']}))""")
def balanced_training_rows(spark, sf):
    """Per class its rows after balancing, new rows, new rows off the line between their two ends, and ends that are no row of the class."""
    rows = stored(spark, sf, "training")
    scaled = research.scaled(rows, SERVING_FEATURES).transform(rows).select(vector_to_array(model.VECTOR).alias("values"), "target")
    made = balance.new_rows(scaled, "values")
    # from the origin to the new row and on to the other end is no longer than straight on
    apart = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    detour = apart("_origin", "values") + apart("values", "_other") - apart("_origin", "_other")
    named = lambda value: [c.alias(n) for n, c in balance.identity(value).items()]
    real = scaled.select("target", F.transform("values", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("end")).select("target", *named("end")).distinct()
    # both ends of a new row are looked up by one join, by their names
    end = lambda c, first, off: F.struct(F.col(c).alias("end"), first.alias("first"), off.alias("off"))
    ends = F.array(end("_origin", F.lit(True), ~(F.abs(detour) <= 1e-9)), end("_other", F.lit(False), F.lit(False)))
    ends = made.select("target", F.inline(ends)).select("target", *named("end"), "first", "off").join(real.withColumn("known", F.lit(1)), ["target", "a", "b"], "left")
    new = ends.groupBy("target").agg(F.count_if("first").alias("n_new"), F.count_if("off").alias("off_segment"), F.count_if(F.col("known").isNull()).alias("unknown_ends"))
    both = scaled.groupBy("target").agg(F.count(F.lit(1)).alias("n")).join(new, "target", "left").na.fill(0)
    return both.select("target", (F.col("n") + F.col("n_new")).alias("n_rows"), "n_new", "off_segment", "unknown_ends")


@query("M-09 A-17 M-14 O-04")
def feature_contributions(spark, sf):
    """Mean absolute contribution on the row sample, beside the split importance."""
    train, _ = periods(spark, sf)
    fitted = model.fit(train, SERVING_FEATURES)
    split = research.importance(fitted, SERVING_FEATURES, spark)
    return research.mean_contribution(fitted, train, SERVING_FEATURES).join(split, "feature").orderBy(
        F.desc("mean_abs_contribution"), "feature"
    )


@query("M-10 M-15")
def parameter_search(spark, sf):
    """Twenty random settings of the search space, cross-validated on precision in five folds."""
    train, _ = periods(spark, sf, "research")
    return research.random_search(model.narrowed(train, RESEARCH_FEATURES), RESEARCH_FEATURES)


@query("M-11")
def parameter_tuning(spark, sf):
    """A hundred random settings of the larger space, cross-validated on precision in five folds."""
    train, _ = periods(spark, sf, "research")
    return research.random_search(train, RESEARCH_FEATURES, n=research.TUNING_DRAWS, space=research.TUNING_SPACE)


def _ranked(train: DataFrame) -> DataFrame:
    """All candidate features by their exact contribution to the candidate model on the row sample."""
    forest = extra_trees.grow(train, RESEARCH_FEATURES, [extra_trees.CANDIDATE])[0]
    return extra_trees.mean_contributions(forest, repeatable_sample(train, research.SAMPLE_ROWS, research.SAMPLE_SEED, "Ticker", "Date"))


@query("M-12 O-05")
def feature_count_experiment(spark, sf):
    """Metrics of models on all 65 features and on the best 40, 30, 23, 20, 15 and 10."""
    train, test = periods(spark, sf, "research")
    ranked = research.top_features(_ranked(train), len(RESEARCH_FEATURES))
    return research.feature_count_experiment(train, test, ranked)


@query("M-13")
def best_features(spark, sf):
    """The best 30 of the 65 candidate features."""
    train, _ = periods(spark, sf, "research")
    return _ranked(train).limit(research.BEST_FEATURES)


def _judged(spark, sf):
    """Stored predictions judged against a deterministic truth."""
    key = F.regexp_extract("Ticker", "([0-9]+)", 1).cast("bigint")
    return stored(spark, sf, "screening").withColumn("target", F.when(key % 3 == 0, 1).otherwise(0))


_JUDGED = """judged AS (SELECT *, CASE WHEN CAST(regexp_extract(Ticker, '([0-9]+)', 1) AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS target FROM screening),
c AS (SELECT COUNT(*) FILTER (WHERE target = 0 AND Prediction = 0) AS tn, COUNT(*) FILTER (WHERE target = 0 AND Prediction = 1) AS fp,
  COUNT(*) FILTER (WHERE target = 1 AND Prediction = 0) AS fn, COUNT(*) FILTER (WHERE target = 1 AND Prediction = 1) AS tp FROM judged)"""


@query("A-15", over("screening", body="").rstrip() + ",\n" + _JUDGED + """
SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive FROM c""")
def confusion_counts(spark, sf):
    return evaluation.confusion(_judged(spark, sf))


@query("A-16", over("screening", body="").rstrip() + ",\n" + _JUDGED + """,
s AS (SELECT *, 1.0 * tn / (tn + fn) AS p0, 1.0 * tn / (tn + fp) AS r0, 1.0 * tp / (tp + fp) AS p1, 1.0 * tp / (tp + fn) AS r1,
  tn + fp AS n0, tp + fn AS n1, tn + fp + fn + tp AS n FROM c),
f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM s)
SELECT class, ROUND(precision_, 6) AS "precision", ROUND(recall_, 6) AS recall, ROUND(f1_, 6) AS f1_score, support FROM (
  SELECT '0' AS class, p0 AS precision_, r0 AS recall_, f0 AS f1_, n0 AS support FROM f
  UNION ALL SELECT '1', p1, r1, f1, n1 FROM f
  UNION ALL SELECT 'accuracy', 1.0 * (tn + tp) / n, 1.0 * (tn + tp) / n, 1.0 * (tn + tp) / n, n FROM f
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM f)""")
def classification_report(spark, sf):
    return rounded(evaluation.report(evaluation.confusion(_judged(spark, sf))))


# ---- extremely randomised trees ------------------------------------------------------------------
# The other engine cannot draw the thresholds. It tells the counts that every tree must add up to, and that nothing departs
# from the rules and from a plain walk over the stored nodes.

_TRAINING = f"(SELECT COUNT(*) AS n, SUM(target) AS ones FROM ({ORACLES['training_rows']}))"


def _forest(spark, sf, setting) -> extra_trees.Forest:
    return extra_trees.grow(stored(spark, sf, "training"), SERVING_FEATURES, [setting])[0]


@query("M-02 M-05 M-07 S-11 K-07 J-05", f"""
SELECT CAST(t.range AS INTEGER) AS tree, n AS n_rows, CAST(ones AS BIGINT) AS n_ones, 0::BIGINT AS wrong_counts, 0::BIGINT AS broken_limits, 0::BIGINT AS differing_rows
FROM range(100) t, {_TRAINING}""")
def extra_trees_nodes(spark, sf):
    """The deployed model, stored and loaded: per tree its rows, nodes with other counts than a walk by SQL finds, nodes beyond a
    limit, and rows whose prediction differs from the walk."""
    rows = stored(spark, sf, "training")
    path = shared_dir(spark, "extra-trees")
    extra_trees.save(_forest(spark, sf, extra_trees.FINAL), path, spark)
    forest = extra_trees.load(spark, path)
    nodes = spark.read.parquet(f"{path}/nodes")
    scored = extra_trees.predict(forest, rows).select("target", "Probability", F.array(*[extra_trees.leaf(forest, k) for k in range(len(forest.trees))]).alias("leaves"))
    walked = scored.select("target", F.posexplode("leaves").alias("tree", "node")).groupBy("tree", "node")
    walked = walked.agg(F.count_if(F.col("target") == 0).alias("m0"), F.count_if(F.col("target") == 1).alias("m1"))
    both = nodes.join(walked, ["tree", "node"], "left")
    leaf, size = F.col("feature") < 0, F.col("n0") + F.col("n1")
    wrong = leaf & ((F.coalesce("m0", F.lit(0)) != F.col("n0")) | (F.coalesce("m1", F.lit(0)) != F.col("n1")))
    broken = (F.col("depth") > 3) | (size < 5) | (~leaf & (size < 20))
    # one sum of looked-up leaf values per row
    values = F.array(*[F.array(*[F.lit(float(p)) for p in forest.values(t)]) for t in forest.trees])
    walk = F.aggregate(F.transform("leaves", lambda v, t: F.get(F.get(values, t), v)), F.lit(0.0), lambda a, x: a + x) / len(forest.trees)
    differing = scored.agg(F.count_if(F.abs(walk - F.col("Probability")) > 1e-12).alias("differing_rows")).scalar()
    return both.groupBy("tree").agg(
        F.sum(F.when(leaf, size)).alias("n_rows"), F.sum(F.when(leaf, F.col("n1"))).alias("n_ones"), F.count_if(wrong).alias("wrong_counts"), F.count_if(broken).alias("broken_limits"),
    ).withColumn("differing_rows", differing)


@query("M-03", f"""
SELECT CAST(t.range AS INTEGER) AS tree, n AS n_rows, 0::BIGINT AS leaves_over_limit, 0::BIGINT AS out_of_order FROM range(100) t, {_TRAINING}""")
def best_first_trees(spark, sf):
    """The candidate model with at most 30 leaves: per tree its rows, leaves too many, and splits made while a better one was open."""
    nodes = extra_trees.nodes_frame(spark, _forest(spark, sf, extra_trees.CANDIDATE))
    leaf = F.col("feature") < 0
    made = nodes.where(~leaf).select("tree", F.col("split_at").alias("at"), F.col("gain").alias("taken"))
    until = F.when(leaf, 2**31 - 1).otherwise(F.col("split_at"))
    other = nodes.select("tree", "opened", until.alias("until"), F.col("best_gain").alias("own")).where("own IS NOT NULL")
    bad = made.join(other, "tree").where("opened <= at AND at < until AND taken < own - 1e-15").groupBy("tree").agg(F.count(F.lit(1)).alias("bad"))
    sums = nodes.groupBy("tree").agg(F.sum(F.when(leaf, F.col("n0") + F.col("n1"))).alias("n_rows"), F.count_if(leaf).alias("leaves"))
    return sums.join(bad, "tree", "left").select("tree", "n_rows", F.greatest(F.col("leaves") - 30, F.lit(0)).cast("bigint").alias("leaves_over_limit"), F.coalesce("bad", F.lit(0).cast("bigint")).alias("out_of_order"))


@query("M-02 M-06 A-16")
def extra_trees_report(spark, sf):
    """The deployed model fitted before the split day; reports on both periods."""
    train, test = periods(spark, sf)
    forest = extra_trees.grow(train, SERVING_FEATURES, [extra_trees.FINAL])[0]
    out = None
    for name, frame in (("train", train), ("test", test)):
        one = evaluation.report(evaluation.confusion(extra_trees.predict(forest, frame))).select(F.lit(name).alias("period"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("M-09 A-17", f"SELECT LEAST(n, 500) AS n_rows, 0::BIGINT AS rows_that_do_not_add_up FROM {_TRAINING}")
def contributions_add_up(spark, sf):
    """Exact contributions of the row sample: base and contributions must give the predicted probability."""
    forest = _forest(spark, sf, extra_trees.FINAL)
    rows = repeatable_sample(stored(spark, sf, "training"), research.SAMPLE_ROWS, research.SAMPLE_SEED, "Ticker", "Date")
    each = extra_trees.contributions(forest, extra_trees.predict(forest, rows))
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return each.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~(F.abs(total - F.col("Probability")) <= 1e-9)).alias("rows_that_do_not_add_up"))


@query("M-09 A-17 M-13 M-14")
def exact_contributions(spark, sf):
    """Mean absolute contribution of every feature on the row sample, best first."""
    train, _ = periods(spark, sf)
    forest = extra_trees.grow(train, SERVING_FEATURES, [extra_trees.CANDIDATE])[0]
    return extra_trees.mean_contributions(forest, repeatable_sample(train, research.SAMPLE_ROWS, research.SAMPLE_SEED, "Ticker", "Date"))
