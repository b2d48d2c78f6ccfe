"""Severity model: data preparation, exact stratified split, weighted training, scoring, metrics, gates.

Training and scoring stay on the cluster: the features are assembled into a
vector and an MLlib ``RandomForestClassifier`` (multiclass, class weights) is
fitted with distributed tree induction; ``PipelineModel.transform`` scores in
the JVM, so no Python worker hop and no collect to a single machine.

All metrics are computed from a confusion matrix — a tiny aggregate
(classes²) — so evaluation is one pass over the predictions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bands import LABELS, severity_label
from ..session import scratch_path, written

DEFAULT_PARAMS = {"numTrees": 60, "maxDepth": 6, "maxBins": 32, "seed": 42, "subsamplingRate": 0.8,
                  "featureSubsetStrategy": "sqrt"}
# Fixed gate thresholds of the reference's validation job.
GATES = {"accuracy": 0.75, "f1_weighted": 0.73, "f1_macro": 0.65, "f1_total_loss": 0.55}
HASH_DIGITS, SPLIT_DIGITS = 32, 3   # hex digits of a split hash, and of them looked at in one pass (4096 counts a class)
MOST_CLASSES = 1000


def class_distribution(f: DataFrame, label: str) -> DataFrame:
    """Count and percentage per label, from one pass; the total is summed over the classes' counts."""
    counts = f.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(F.col("count") / total * 100, 2))


def prepare_training(f: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Features + label, rows without a label dropped, missing features 0, all double."""
    out = f.select(*keys, *features, label).dropna(subset=[label]).fillna(0, subset=list(features))
    return out.select(*keys, *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int"))


def _split_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


@dataclass(frozen=True)
class ClassCut:
    """Of the ``n`` rows of class ``label``, the ``n_test`` whose hash is at most ``cut`` are test rows."""

    label: object
    n: int
    n_test: int
    cut: str


def class_cuts(f: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42) -> list[ClassCut]:
    """The round(test·n_c)-th smallest ``md5(key|seed)`` of every class c, exactly, by radix refinement.

    A pass counts the rows of each class by the next ``SPLIT_DIGITS`` hex digits (map-side partial sums, at most 4096
    counts a class), finds the digits that hold the wanted rank, and the next pass looks only at hashes that begin with
    them, until a cut between two buckets is exact: about log(n_c) / log(4096) passes.  They read a written table of
    (label, hash) and nothing else; the driver holds one row per class (``MOST_CLASSES`` at most, more raise ValueError).

    Rows of one key have one hash and stay on one side, so a class with repeated keys may get a few test rows more than
    round(test·n_c).  Rows without a label belong to no class; an empty table has no cuts.
    """
    spark = f.sparkSession
    path = scratch_path(spark, "split-hashes")
    (f.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), _split_hash(F.col(key), seed).alias("h"))
     .write.parquet(path))
    hashes = spark.read.parquet(path)
    share = F.floor((F.col("n") * int(round(test * 100)) + 50) / 100)
    done: list[ClassCut] = []
    sizes: dict = {}
    open_: dict = {}        # class → (prefix, rank wanted among the hashes that begin with it)
    for depth in range(0, HASH_DIGITS, SPLIT_DIGITS):
        rows, want = hashes, share
        if depth:
            rows = hashes.filter(F.substring("h", 1, depth) == _by_class({c: p for c, (p, _) in open_.items()}, F.col("label")))
            want = _by_class({c: k for c, (_, k) in open_.items()}, F.col("label"))
        counts = rows.groupBy("label", F.substring("h", depth + 1, SPLIT_DIGITS).alias("d")).agg(F.count(F.lit(1)).alias("n"))
        found = (counts.groupBy("label").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("d", "n"))).alias("buckets"))
                 .withColumn("want", want.cast("long")).withColumn("at", F.expr(
                     """aggregate(buckets, named_struct('before', 0L, 'd', cast(null as string), 'n', 0L),
                          (s, x) -> CASE WHEN s.d IS NOT NULL THEN s
                                         WHEN s.before + x.n >= want THEN named_struct('before', s.before, 'd', x.d, 'n', x.n)
                                         ELSE named_struct('before', s.before + x.n, 'd', cast(null as string), 'n', 0L) END)"""))
                 .select("label", "n", "want", "at").limit(MOST_CLASSES + 1).collect())
        if len(found) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes in {label}")
        before, open_ = open_, {}
        for r in found:
            n, k = sizes.setdefault(r.label, (r.n, r.want))
            if k == 0:
                done.append(ClassCut(r.label, n, 0, ""))
                continue
            prefix = (before[r.label][0] if depth else "") + r["at"].d
            left = r.want - r["at"].before
            if left == r["at"].n or len(prefix) >= HASH_DIGITS:
                done.append(ClassCut(r.label, n, k - left + r["at"].n, prefix.ljust(HASH_DIGITS, "f")))
            else:
                open_[r.label] = (prefix, left)
        if not open_:
            break
    return sorted(done, key=lambda c: str(c.label))


def _by_class(values: dict, label: Column) -> Column:
    """The value of a row's class; null for a class without one."""
    out = F.lit(None)
    for c, v in values.items():
        out = F.when(label == F.lit(c), F.lit(v)).otherwise(out)
    return out


def stratified_split(f: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42,
                     cuts: Sequence[ClassCut] | None = None) -> DataFrame:
    """Exact per-class split: of the n_c rows of class c, the round(test·n_c) rows with the smallest ``md5(key|seed)`` go
    to test (repeated keys: see :func:`class_cuts`).  Re-runnable and independent of partitioning; rows without a label
    are train rows.

    With the cuts known the split is one comparison a row: no window, no shuffle, no copy of the wide rows.
    """
    cuts = class_cuts(f, label, key, test, seed) if cuts is None else cuts
    cut = _by_class({c.label: c.cut for c in cuts}, F.col(label))
    return f.withColumn("is_test", F.coalesce(_split_hash(F.col(key), seed) <= cut, F.lit(False)))


def split_weights(spark: SparkSession, cuts: Sequence[ClassCut], label: str, label_type: str = "int") -> DataFrame:
    """:func:`class_weights` of the train rows of a split, from its cuts alone: no row is read again."""
    n_c = {c.label: c.n - c.n_test for c in cuts if c.n > c.n_test}
    total = sum(n_c.values())
    return spark.createDataFrame([(c, m, total / (len(n_c) * m)) for c, m in n_c.items()],
                                 f"{label} {label_type}, n_c long, weight double")


def class_weights(f: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k · n_c)`` per class (k = number of classes present)."""
    counts = f.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy()      # over one row per class
    return counts.withColumn("weight", F.sum("n_c").over(every) / (F.count(F.lit(1)).over(every) * F.col("n_c")))


def with_class_weights(f: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the class weight to every row (the weight table has one row per class: broadcast)."""
    return f.join(F.broadcast(class_weights(f, label).select(label, F.col("weight").alias(weight_col))),
                  label, "left")


def train_severity(train: DataFrame, features: Sequence[str], label: str, params: dict | None = None,
                   weight_col: str | None = "weight") -> PipelineModel:
    p = dict(DEFAULT_PARAMS, **(params or {}))
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, probabilityCol="probability",
                                predictionCol="prediction", rawPredictionCol="raw", **p)
    if weight_col:
        rf.setWeightCol(weight_col)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    # Tree induction reads the rows several times: only what it needs is written, in columns, and read from there.
    rows = written(assembler.transform(train).select("features", label, *([weight_col] if weight_col else [])), "train")
    return PipelineModel([assembler, rf.fit(rows)])


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str],
                       top: int | None = None) -> DataFrame:
    """Model metadata (one value per feature), sorted; bounded by the feature count."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
    return out if top is None else out.limit(top)


def score_claims(f: DataFrame, model: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Class probabilities per row as ``array<double>`` (model shipped once by ``transform``)."""
    scored = model.transform(f)
    return scored.select(*keep, vector_to_array("probability").alias("probs"))


def decode_prediction(scored: DataFrame, version: str | Column, run_ts: datetime | str | Column) -> DataFrame:
    """probs → four probability columns, argmax class (first maximum), label, lineage."""
    p = F.col("probs")
    pred = (F.array_position(p, F.array_max(p)) - 1).cast("int")
    ver = version if isinstance(version, Column) else F.lit(version)
    ts = run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp_ntz")
    cols = [c for c in scored.columns if c != "probs"]
    return scored.select(
        *cols,
        *[p[i].alias(f"prob_{name}") for i, name in enumerate(LABELS)],
        pred.alias("predicted_severity"),
        severity_label(pred).alias("predicted_severity_label"),
        ver.alias("model_version"),
        ts.alias("scored_at"),
    )


# ── evaluation ────────────────────────────────────────────────────────────────
def confusion_matrix(p: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return (p.filter(F.col(actual).isNotNull()).groupBy(*by, F.col(actual).alias("actual"),
                                                        F.col(pred).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def _class_stats(cm: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per class: true positives, support (actual) and predicted totals, f1, precision, recall."""
    a, pr, n = F.col("actual"), F.col("predicted"), F.col("n")
    parts = F.array(
        F.struct(a.alias("cls"), F.when(a == pr, n).otherwise(F.lit(0)).alias("tp"), n.alias("sup"),
                 F.lit(0).cast("bigint").alias("pred")),
        F.struct(pr.alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("sup"),
                 n.alias("pred")),
    )
    s = (cm.select(*by, F.explode(parts).alias("_s"))
         .groupBy(*by, F.col("_s.cls").alias("cls"))
         .agg(F.sum("_s.tp").alias("tp"), F.sum("_s.sup").alias("support"), F.sum("_s.pred").alias("predicted")))
    return s.select(
        *by, "cls", "tp", "support", "predicted",
        F.coalesce(F.col("tp") / F.nullif(F.col("predicted"), F.lit(0)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.col("tp") / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0)).alias("recall"),
        (2 * F.col("tp") / (F.col("support") + F.col("predicted"))).alias("f1"),
    )


def classification_metrics(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, f1 weighted/macro and f1 per class, one row per ``by`` group."""
    s = _class_stats(cm, by)
    per_class = [F.max(F.when(F.col("cls") == i, F.col("f1"))).alias(f"f1_{name}") for i, name in enumerate(LABELS)]
    return s.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        *per_class,
        F.sum("support").alias("support"),
    )


def classification_report(cm: DataFrame) -> DataFrame:
    """precision, recall, f1, support per class, plus accuracy / macro avg / weighted avg rows."""
    s = _class_stats(cm, [])
    per = s.select(severity_label(F.col("cls")).alias("label"), "precision", "recall", "f1",
                   F.col("support").cast("bigint").alias("support"))
    tot = s.agg(F.sum("support").alias("N"), F.sum("tp").alias("TP"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("TP") / F.col("N")).alias("f1"),
                     F.col("N").alias("support"))
    macro = s.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wsum = F.sum("support")
    weighted = s.agg(F.lit("weighted avg").alias("label"),
                     (F.sum(F.col("precision") * F.col("support")) / wsum).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / wsum).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / wsum).alias("f1"), wsum.alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def offline_accuracy(p: DataFrame, actual: str = "severity_encoded", pred: str = "predicted_severity") -> DataFrame:
    """Overall accuracy over *all* rows (NULL labels count as wrong, as in the reference) and per class."""
    ok = F.col(actual) == F.col(pred)
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("correct")]
    for i, name in enumerate(LABELS):
        aggs += [F.count_if(F.col(actual) == i).alias(f"n_{name}"),
                 F.count_if((F.col(actual) == i) & ok).alias(f"correct_{name}")]
    r = p.agg(*aggs)
    return r.select("total", "correct", (F.col("correct") / F.col("total")).alias("accuracy"),
                    *[(F.col(f"correct_{n}") / F.nullif(F.col(f"n_{n}"), F.lit(0))).alias(f"accuracy_{n}")
                      for n in LABELS])


def predictions_summary(p: DataFrame) -> DataFrame:
    return (p.groupBy("predicted_severity_label")
            .agg(F.count(F.lit(1)).alias("predictions"),
                 F.round(F.avg(F.when(F.col("predicted_severity") == F.col("severity_encoded"), 1.0)
                               .otherwise(0.0)), 3).alias("accuracy"),
                 F.round(F.avg("prob_total_loss"), 4).alias("avg_total_loss_confidence"))
            .orderBy("predicted_severity_label"))


def validation_gates(metrics: DataFrame, thresholds: dict[str, float] = GATES) -> DataFrame:
    """One row per gate (score, threshold, passed) plus an ``overall`` row; thresholds are literals."""
    parts = ", ".join(f"'{g}', CAST(`{g}` AS DOUBLE), CAST({float(t)!r} AS DOUBLE)" for g, t in thresholds.items())
    gates = metrics.selectExpr(f"stack({len(thresholds)}, {parts}) AS (gate, score, threshold)")
    gates = gates.withColumn("passed", F.coalesce(F.col("score") >= F.col("threshold"), F.lit(False)))
    overall = gates.agg(F.lit("overall").alias("gate"), F.lit(None).cast("double").alias("score"),
                        F.lit(None).cast("double").alias("threshold"), F.bool_and("passed").alias("passed"))
    return gates.unionByName(overall)


def assert_gates(gates: DataFrame) -> None:
    """Raise when the overall gate fails (the job's stop signal); reads one row."""
    row = gates.filter(F.col("gate") == "overall").select("passed").first()
    if row is None or not row[0]:
        failed = [r[0] for r in gates.filter(~F.col("passed") & (F.col("gate") != "overall")).select("gate")
                  .collect()]
        raise RuntimeError(f"validation failed — gates not met: {failed}")


class ModelRegistry:
    """Versions and aliases of a model as a small parquet table (one row per event).

    ``register`` appends a version, ``set_alias`` appends an alias assignment;
    ``resolve`` returns the newest assignment of an alias — the table is
    append-only, so concurrent readers never see a half-written state.
    """

    SCHEMA = "model_name string, version int, alias string, artifact_path string, event_ts timestamp_ntz"

    def __init__(self, spark: SparkSession, path: str, model_name: str):
        self.spark, self.path, self.model_name = spark, path, model_name

    def _append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)

    def register_versions(self, versions: DataFrame) -> None:
        """Append versions from a frame with (version int, artifact_path string, event_ts)."""
        self._append(versions.select(F.lit(self.model_name).alias("model_name"), F.col("version").cast("int"),
                                     F.lit(None).cast("string").alias("alias"), "artifact_path",
                                     F.col("event_ts").cast("timestamp_ntz")))

    def set_alias_to_latest(self, alias: str = "champion") -> None:
        """Point ``alias`` at the newest registered version (computed on the cluster)."""
        t = self.table().filter(F.col("alias").isNull())
        latest = t.agg(F.max_by(F.struct("version", "artifact_path", "event_ts"), F.col("version")).alias("v"))
        self._append(latest.select(F.lit(self.model_name).alias("model_name"), F.col("v.version"),
                                   F.lit(alias).alias("alias"), F.col("v.artifact_path"), F.col("v.event_ts")))

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).filter(F.col("model_name") == self.model_name)

    def resolve(self, alias: str = "champion") -> DataFrame:
        t = self.table().filter(F.col("alias") == alias)
        return (t.groupBy("model_name", "alias")
                .agg(F.max_by(F.struct("version", "artifact_path"), F.struct("event_ts", "version")).alias("v"))
                .select("model_name", "alias", F.col("v.version").alias("version"),
                        F.col("v.artifact_path").alias("artifact_path")))
