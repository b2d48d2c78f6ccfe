"""Split exactness, metrics against hand computation, drift sanity."""

import collections
import datetime
import hashlib
import math
import statistics

from pyspark.sql import functions as F

from claimlake.operators import model, monitor


def test_stratified_split_is_exact_and_rerunnable(spark):
    df = spark.range(0, 2003).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("y"))
    a = model.stratified_split(df, "y", "k", 0.2, 42)
    counts = {r["y"]: (r["n"], r["t"]) for r in a.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    for y, (n, t) in counts.items():
        assert t == (n * 20 + 50) // 100
    b = model.stratified_split(df.repartition(7), "y", "k", 0.2, 42)
    assert a.exceptAll(b).count() == 0


def test_split_cuts_equal_a_plain_sort(spark):
    """Hot class, tiny classes, repeated keys (one side), rows without a label or key, an empty table."""
    rows = ([(f"k{i}", 0) for i in range(9000)] + [(f"m{i}", 1) for i in range(3)] + [("x", 2)] + [("d", 3)] * 5
            + [(f"e{i}", 3) for i in range(20)] + [(None, 4), ("n", None)])
    df = spark.createDataFrame(rows, "k string, y int")

    def plain(key):
        return hashlib.md5("|".join(([key] if key is not None else []) + ["42"]).encode()).hexdigest()

    expect, sizes = {}, {}
    for y in range(5):
        hashes = sorted(plain(k) for k, c in rows if c == y)
        k = (len(hashes) * 20 + 50) // 100
        cut = hashes[k - 1] if k else ""
        sizes[y] = (len(hashes), sum(h <= cut for h in hashes))
        expect |= {(key, c): plain(key) <= cut for key, c in rows if c == y}
    cuts = model.class_cuts(df, "y", "k")
    assert {c.label: (c.n, c.n_test) for c in cuts} == sizes
    split = model.stratified_split(df, "y", "k", cuts=cuts).collect()
    assert len(split) == len(rows)
    assert {(r.k, r.y): r.is_test for r in split} == expect | {("n", None): False}
    weights = {r.y: (r.n_c, r.weight) for r in model.split_weights(spark, cuts, "y").collect()}
    train = df.exceptAll(model.stratified_split(df, "y", "k", cuts=cuts).filter("is_test").drop("is_test"))
    assert weights == {r.y: (r.n_c, r.weight) for r in model.class_weights(train, "y").collect()}
    assert model.class_cuts(df.limit(0), "y", "k") == []
    assert model.stratified_split(df.limit(0), "y", "k").count() == 0


def test_metrics_match_hand_computation(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 1)] + [(3, 3)]
    p = spark.createDataFrame(rows, "a int, p int")
    m = model.classification_metrics(model.confusion_matrix(p, "a", "p")).collect()[0]
    assert abs(m["accuracy"] - 6 / 8) < 1e-12
    f1_0, f1_1, f1_2, f1_3 = 2 * 3 / (4 + 3), 2 * 2 / (2 + 4), 0.0, 1.0
    assert abs(m["f1_macro"] - (f1_0 + f1_1 + f1_2 + f1_3) / 4) < 1e-12
    assert abs(m["f1_weighted"] - (4 * f1_0 + 2 * f1_1 + 1 * f1_2 + 1 * f1_3) / 8) < 1e-12


def test_gates_fail_and_pass(spark):
    metrics = spark.createDataFrame([(0.8, 0.8, 0.7, 0.6)], "accuracy double, f1_weighted double, "
                                    "f1_macro double, f1_total_loss double")
    g = {r["gate"]: r["passed"] for r in model.validation_gates(metrics).collect()}
    assert g["overall"] is True
    low = metrics.withColumn("f1_macro", F.lit(0.1))
    assert {r["gate"]: r["passed"] for r in model.validation_gates(low).collect()}["overall"] is False


def test_decode_takes_first_maximum(spark):
    df = spark.createDataFrame([([0.1, 0.4, 0.4, 0.1],)], "probs array<double>")
    r = model.decode_prediction(df, "1", "2026-02-17 00:00:00").collect()[0]
    assert (r["predicted_severity"], r["predicted_severity_label"]) == (1, "moderate")


def test_identical_windows_have_no_drift(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, d, 1), 0.1 * (i % 10)) for d in (1, 2) for i in range(100)]
    p = spark.createDataFrame(rows, "ts timestamp, prob_x double")
    d = monitor.monitor_drift(p, "ts", ["prob_x"], "1 day").collect()
    assert len(d) == 1 and d[0]["js_distance"] < 1e-6 and d[0]["drift_severity"] == "none"


def _log(spark):
    import datetime as dt
    rows = []
    for i in range(4000):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * (i % 97), minutes=i % 59)
        if at.day % 5 == 0:          # days without rows
            continue
        x = None if i % 11 == 0 else 1e6 + ((i * 7919) % 1000) / 1000
        rows.append((at, x, None if at.day < 4 else (i % 10) / 10, i % 4, (i * 3) % 5 % 4, None if i % 3 == 0 else f"v{i % 2}"))
    return rows, spark.createDataFrame(rows, "ts timestamp_ntz, x double, prob_x double, a int, p int, version string")


def test_profile_merges_to_what_all_rows_give(spark):
    """Large mean, small spread, nulls, a column without values at first, a null slice."""
    rows, log = _log(spark)
    got = {(r.granularity, str(r.window_start), r.slice_key, r.slice_value, r.column_name): r
           for r in monitor.monitor_profile(log, "ts", ["x", "prob_x"], ["version"]).collect()}
    cells = collections.defaultdict(list)
    for at, x, prob, _, _, version in rows:
        day = at.replace(hour=0, minute=0)
        for g, start in (("1 day", day), ("1 week", day - datetime.timedelta(day.weekday()))):
            for key, value in (("all", None), ("version", version)):
                for c, v in (("x", x), ("prob_x", prob)):
                    cells[g, str(start), key, value, c].append(v)
    assert set(got) == set(cells)
    for k, values in cells.items():
        r, there = got[k], [v for v in values if v is not None]
        assert r["count"] == len(values) and abs(r.percent_null - 100 * (len(values) - len(there)) / len(values)) < 1e-9
        assert (r.min_value, r.max_value) == ((min(there), max(there)) if there else (None, None))
        assert r.mean is None if not there else abs(r.mean - statistics.fmean(there)) < 1e-6
        assert r.std_dev is None if len(there) < 2 else abs(r.std_dev - statistics.stdev(there)) < 1e-7


def test_quality_and_drift_equal_plain_python(spark):
    rows, log = _log(spark)
    quality = monitor.monitor_quality(log, "ts", "a", "p", ["version"])
    for r in quality.collect():
        days = 1 if r.granularity == "1 day" else 7
        mine = [(a, p) for at, _, _, a, p, v in rows if r.window_start <= at < r.window_start + datetime.timedelta(days)
                and (r.slice_key == "all" or v == r.slice_value)]
        assert r.support == len(mine) and abs(r.accuracy - sum(a == p for a, p in mine) / len(mine)) < 1e-12
    drift = {(r.column_name, r.window_start): r for r in monitor.monitor_drift(log, "ts", ["a", "prob_x"], "1 day").collect()}
    expect = {}
    for c, of in (("a", lambda r: r[3]), ("prob_x", lambda r: None if r[2] is None else min(int(r[2] * 10 // 1), 9))):
        seen = collections.defaultdict(collections.Counter)
        for r in rows:
            if of(r) is not None:
                seen[r[0].replace(hour=0, minute=0)][of(r)] += 1
        days = sorted(seen)
        for before, day in zip(days, days[1:]):
            keys = set(seen[before]) | set(seen[day])
            n, m, k, e = sum(seen[day].values()), sum(seen[before].values()), len(keys), 1e-6
            p = {b: (seen[day][b] + e) / (n + e * k) for b in keys}
            q = {b: (seen[before][b] + e) / (m + e * k) for b in keys}
            expect[c, day] = (sum(p[b] * math.log(p[b] / q[b]) for b in keys), n, m)
    assert set(drift) == set(expect)
    for k, (kl, n, m) in expect.items():
        assert abs(drift[k].kl_divergence - kl) < 1e-9 and (drift[k]["count"], drift[k].count_prev) == (n, m)


def test_monitors_read_the_log_once(spark, tmp_path):
    _log(spark)[1].write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    for df in (monitor.monitor_profile(log, "ts", ["x", "prob_x"], ["version"]), monitor.monitor_quality(log, "ts", "a", "p", ["version"]),
               monitor.monitor_drift(log, "ts", ["a", "prob_x"])):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
        assert df.limit(0).count() == 0
    assert monitor.monitor_profile(log.limit(0), "ts", ["x"], ["version"]).count() == 0


def test_profile_of_values_without_exact_sum(spark):
    log = spark.sql("SELECT timestamp_ntz '2024-01-01' ts, CAST(v AS DOUBLE) x FROM VALUES (1e30), (3e30), (NULL) t(v)")
    for r in monitor.monitor_profile(log, "ts", ["x"], []).collect():
        assert (r["count"], r.mean, r.min_value, r.max_value) == (3, 2e30, 1e30, 3e30)
