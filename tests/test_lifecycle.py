"""Model life cycle: saved, registered, loaded elsewhere, gated; boosting that stops by itself."""

import pytest
from pyspark.sql import functions as F

from claimlake.operators import lifecycle, model
from claimlake.session import scratch_path

TS = "2026-02-17 06:00:00"
EASY, HARD = dict.fromkeys(model.GATES, 0.5), dict.fromkeys(model.GATES, 1.1)


@pytest.fixture(scope="module")
def rows(spark):
    """A label that two of three features decide, the last class rare."""
    df = spark.range(0, 1200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).cast("double").alias("a"),
                                     (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("noise"))
    y = F.when((F.col("a") == 9) & (F.col("b") > 3), 3).when(F.col("a") > 6, 2).when(F.col("b") > 3, 1).otherwise(0)
    return df.withColumn("y", y.cast("int")).withColumn("weight", F.lit(1.0)).withColumn("is_test", F.pmod(F.xxhash64("k"), F.lit(5)) == 0)


@pytest.fixture(scope="module")
def registry(spark, rows):
    made = lifecycle.Registry(spark, scratch_path(spark, "registry"), "severity")
    with pytest.raises(LookupError):
        made.load()
    train = rows.filter("not is_test")
    assert made.register(model.train_severity(train, ["a", "b", "noise"], "y", {"numTrees": 10}), TS) == 1
    assert made.register(lifecycle.train_boosted(train, ["a", "b", "noise"], "y", "k"), TS) == 2
    return made


def test_promotion_is_gated_by_the_loaded_models_own_predictions(spark, rows, registry):
    held = rows.filter("is_test")
    for version in (1, 2):
        gates = {r.gate: r for r in lifecycle.promote(registry, version, held, "y", TS, EASY).collect()}
        assert gates["overall"].passed and registry.artifact(lifecycle.CHAMPION)[0] == version
    with pytest.raises(RuntimeError, match="accuracy"):
        lifecycle.promote(registry, 1, held, "y", TS, HARD)
    assert registry.artifact(lifecycle.CHAMPION)[0] == 2 and registry.versions().count() == 2
    with pytest.raises(LookupError):
        registry.load(version=9)


def test_scores_of_a_loaded_model_in_another_session(spark, rows, registry):
    registry.point(lifecycle.CHAMPION, 2, "2026-03-01 00:00:00")
    here = lifecycle.score_registered(rows, registry, TS, keep=["k", "y"])
    other = lifecycle.Registry(spark.newSession(), registry.path, "severity")
    there = lifecycle.score_registered(rows, other, TS, keep=["k", "y"])
    assert sorted(map(str, here.collect())) == sorted(map(str, there.collect()))
    assert here.filter("abs(prob_minor + prob_moderate + prob_severe + prob_total_loss - 1) > 1e-9").count() == 0
    assert here.filter("model_version <> '2'").count() == 0 and here.count() == rows.count()
    assert lifecycle.score_registered(rows.limit(0), registry, TS, keep=["k"]).count() == 0


def test_boosting_beats_the_forest_and_stops_by_itself(rows, registry):
    held = rows.filter("is_test")
    f1 = {v: {r.gate: r.score for r in lifecycle.gate_scores(held, registry.load(version=v)[1], "y").collect()}["f1_macro"] for v in (1, 2)}
    assert f1[2] >= f1[1] and f1[2] > 0.9
    noise = lifecycle.train_boosted(rows.withColumn("y", (F.xxhash64("k") % 2 == 0).cast("int")), ["noise"], "y", "k")
    assert all(s.getNumTrees < lifecycle.BOOSTING["maxIter"] for s in noise.stages if hasattr(s, "getNumTrees"))
    probs = [r.probs for r in lifecycle.score(held, noise).collect()]
    assert all(len(p) == 4 and p[2] == p[3] == 0 and abs(sum(p) - 1) < 1e-9 for p in probs)  # two classes never seen


def test_rows_of_a_query_are_joined_and_written_once(spark, tmp_path):
    from claimlake.plans.lake import Lake

    lake, built = Lake(spark, str(tmp_path)), []
    for _ in range(3):
        rows = lake.written("rows", lambda: built.append(1) or spark.range(7).toDF("k"))
        assert sorted(r.k for r in rows.filter("k > 2").collect()) == [3, 4, 5, 6] and rows.inputFiles()
    assert built == [1] and lake.has_written("rows") and not Lake(spark, str(tmp_path)).has_written("rows")


def test_both_models_of_a_query_read_one_split(spark, monkeypatch):
    from claimlake.plans import registry as queries
    from claimlake.plans.lake import Lake

    queries._load()
    from claimlake.plans import catalog_ml

    made, prepared = [], catalog_ml._prepared
    monkeypatch.setattr(catalog_ml, "_prepared", lambda lk: made.append(1) or prepared(lk))
    rows = catalog_ml._scored_checks(Lake(spark, "/root/testdata/sf0.001"))
    assert made == [1] and rows.count() == 2 * prepared(Lake(spark, "/root/testdata/sf0.001")).count()
