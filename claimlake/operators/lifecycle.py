"""Life of a severity model: train (forest or early-stopped boosting), save, register, validate, promote, load, score.

A registry row points to a saved ``PipelineModel``.  Scoring resolves an alias, loads the files and transforms, so any
session that sees the folder scores alike.  Promotion is a step of a run: the candidate is loaded, scored on held-out rows,
its gates are computed from them, and a failed gate raises before the alias moves.

Boosting is one early-stopped ``GBTClassifier`` per class (the share ``valid`` of the rows decides when to stop, so every
class stops by itself); the classes' probabilities are put side by side and scaled to sum to 1 by ML stages, so the whole
model is saved and loaded like any other pipeline.

Defined cases: an alias that was never set raises LookupError; a class without rows in training gets probability 0 from
boosting; rows with missing features are scored (0, as in training, when prepared so); an empty table scores to no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Normalizer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import LABELS
from ..session import checkpoint_dir, written
from . import model

CHAMPION = "champion"
BOOSTING = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.3, "maxBins": 32, "subsamplingRate": 0.8, "seed": 42, "validationTol": 0.001}


def train_boosted(train: DataFrame, features: Sequence[str], label: str, key: str, params: Mapping | None = None,
                  weight_col: str | None = "weight", valid: float = 0.1, classes: int = len(LABELS)) -> PipelineModel:
    """One boosted binary model per class; ``valid`` of the rows, by a hash of ``key``, only decides when each stops."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    held = F.pmod(F.xxhash64(F.lit(0), F.col(key)), F.lit(1000)) < int(valid * 1000)
    rows = written(assembler.transform(train).select("features", label, held.alias("held"), *([weight_col] if weight_col else [])), "train")
    settings = BOOSTING | dict(params or {})
    present = {r[0] for r in rows.filter("not held").select(label).distinct().collect()}  # at most ``classes`` rows
    stages, probabilities = [assembler], []
    for c in sorted(present & set(range(classes))):
        booster = GBTClassifier(featuresCol="features", labelCol="is_class", validationIndicatorCol="held", predictionCol=f"prediction_{c}",
                                **settings).setProbabilityCol(f"probability_{c}").setRawPredictionCol(f"raw_{c}")
        if weight_col:
            booster.setWeightCol(weight_col)
        stages.append(booster.fit(rows.withColumn("is_class", (F.col(label) == c).cast("double"))))
        probabilities.append(c)
    if not probabilities:
        raise ValueError("no labelled rows to train on")
    # Side by side, (no, yes) per class, then every yes; score() puts 0 where training saw no row of a class.
    side = VectorAssembler(inputCols=[f"probability_{c}" for c in probabilities], outputCol="sides")
    yes = VectorSlicer(inputCol="sides", outputCol="yes", indices=[2 * i + 1 for i in range(len(probabilities))])
    return PipelineModel([*stages, side, yes, Normalizer(inputCol="yes", outputCol="probability", p=1.0)])


def score(rows: DataFrame, fitted: PipelineModel, keep: Sequence[str] = (), classes: int = len(LABELS)) -> DataFrame:
    """``keep`` and the class probabilities as ``probs``, one per class also where training saw fewer."""
    seen = [int(s.getOrDefault(s.probabilityCol).rsplit("_", 1)[1]) for s in fitted.stages
            if s.hasParam("probabilityCol") and s.getOrDefault(s.probabilityCol).startswith("probability_")]
    out = model.score_claims(rows, fitted, keep)
    if seen and len(seen) < classes:
        at = {c: i for i, c in enumerate(seen)}
        out = out.withColumn("probs", F.array(*[F.col("probs")[at[c]] if c in at else F.lit(0.0) for c in range(classes)]))
    return out


class Registry(model.ModelRegistry):
    """Versions whose artifact is a saved model under ``<path>-models``; the table stays append-only."""

    def _top(self) -> int:
        try:
            return self.table().agg(F.max("version")).first()[0] or 0
        except Exception as missing:  # noqa: BLE001 - the table's folder comes with its first row
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return 0

    def register(self, fitted: PipelineModel, event_ts: datetime | str) -> int:
        """Saves ``fitted`` as the next version; the row is added after the files are whole."""
        version = self._top() + 1
        artifact = f"{self.path.rstrip('/')}-models/{self.model_name}/v{version}"
        fitted.write().overwrite().save(artifact)
        self.register_versions(self.spark.createDataFrame([(version, artifact, str(event_ts))], "version int, artifact_path string, event_ts string"))
        return version

    def versions(self) -> DataFrame:
        return self.table().filter("alias IS NULL")

    def point(self, alias: str, version: int, event_ts: datetime | str) -> None:
        """Moves ``alias`` to ``version``."""
        row = self.versions().filter(F.col("version") == version).limit(1)
        self._append(row.withColumns({"alias": F.lit(alias), "event_ts": F.lit(str(event_ts)).cast("timestamp_ntz")}))

    def artifact(self, alias: str | None = None, version: int | None = None) -> tuple[int, str]:
        """(version, folder) of an alias or a version; one row."""
        if alias is None:
            row = self.versions().filter(F.col("version") == version).first()
        else:
            row = self.resolve(alias).first() if self._top() else None
        if row is None:
            raise LookupError(f"{self.model_name}: no model for {alias or version}")
        return row.version, row.artifact_path

    def load(self, alias: str | None = CHAMPION, version: int | None = None) -> tuple[int, PipelineModel]:
        number, folder = self.artifact(None if version is not None else alias, version)
        return number, PipelineModel.load(folder)


def score_registered(rows: DataFrame, registry: Registry, run_ts: datetime | str, keep: Sequence[str] = (), alias: str = CHAMPION) -> DataFrame:
    """Predictions of the model that ``alias`` names, with its version."""
    version, fitted = registry.load(alias)
    return model.decode_prediction(score(rows, fitted, keep), str(version), run_ts)


def gate_scores(held_out: DataFrame, fitted: PipelineModel, label: str, thresholds: Mapping[str, float] = model.GATES) -> DataFrame:
    """Gates of a model from its own predictions of ``held_out``."""
    predicted = model.decode_prediction(score(held_out, fitted, [label]), "-", "1970-01-01 00:00:00")
    return model.validation_gates(model.classification_metrics(model.confusion_matrix(predicted, label, "predicted_severity")), dict(thresholds))


def promote(registry: Registry, version: int, held_out: DataFrame, label: str, run_ts: datetime | str,
            thresholds: Mapping[str, float] = model.GATES, alias: str = CHAMPION) -> DataFrame:
    """Points ``alias`` at ``version`` if its gates hold on ``held_out``; raises RuntimeError otherwise, and the alias stays."""
    _, fitted = registry.load(version=version)
    checkpoint_dir(held_out.sparkSession)
    gates = gate_scores(held_out, fitted, label, thresholds).checkpoint()
    model.assert_gates(gates)
    registry.point(alias, version, run_ts)
    return gates
