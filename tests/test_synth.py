"""Generator: deterministic under repartitioning, storm share, and every bad row is quarantined by an id rule."""

from pyspark.sql import functions as F

from claimlake.operators import silver
from claimlake.sources import synth


def _spines(spark, n=4000):
    base = spark.range(0, n)
    return {e: base for e in silver.RULES}


def test_generator_is_stable_under_repartitioning(spark):
    a = synth.synthetic_entities(_spines(spark))["claims"]
    b = synth.synthetic_entities({e: s.repartition(5) for e, s in _spines(spark).items()})["claims"]
    assert a.exceptAll(b).count() == 0 and a.count() == 4000


def test_storm_share_close_to_parameter(spark):
    c = synth.synthetic_entities(_spines(spark, 20000))["claims"]
    share = c.filter(F.col("is_storm_related") == "Y").count() / c.count()
    assert abs(share - 0.35) < 0.02
    shifted = synth.shifted_batch(_spines(spark, 20000))["claims"]
    assert abs(shifted.filter(F.col("is_storm_related") == "Y").count() / shifted.count() - 0.10) < 0.02


def test_every_bad_row_breaks_an_id_rule(spark):
    ents = synth.synthetic_entities(_spines(spark))
    for e, df in ents.items():
        failed = silver.failing(e, df)
        assert failed.count() > 0
        assert failed.filter(~F.col("_dq").startswith("invalid_")).count() == 0
