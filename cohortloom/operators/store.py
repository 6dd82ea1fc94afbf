"""Saving and loading what training returns: single, calibrated and combined models, their metrics
and their manifest. Models are Spark ML folders; descriptions are one-row JSON tables."""
from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.boost import BoostedModel
from cohortloom.operators.forest import ForestModel
from cohortloom.operators.learn import PRESETS, CalibratedScorer, Calibrator, Ensemble, Scorer, Spec

MANIFEST_VERSION = 1


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).where("value <> ''").first()["value"])


def _save(model: Model | ForestModel | BoostedModel, path: str) -> None:
    if isinstance(model, (ForestModel, BoostedModel)):
        return model.save(path)
    PipelineModel(stages=[model]).write().overwrite().save(path)


def _load(path: str) -> Model:
    return PipelineModel.load(path).stages[0]


def _load_learner(spark: SparkSession, spec: Spec, path: str) -> Model | ForestModel | BoostedModel:
    own = {"forest": ForestModel, "boosted": BoostedModel}.get(PRESETS[spec.name]["family"])
    return own.load(spark, path) if own else _load(path)


def save(spark: SparkSession, scorer: Scorer | CalibratedScorer | Ensemble, path: str) -> None:
    """Write a model of any kind to a folder."""
    about: dict = {"kind": type(scorer).__name__}
    if isinstance(scorer, Ensemble):
        about |= {"base": list(scorer.base), "meta": scorer.meta is not None}
        for name, part in scorer.base.items():
            save(spark, part, f"{path}/base-{name}")
        if scorer.meta is not None:
            save(spark, scorer.meta, f"{path}/meta")
    else:
        spec = asdict(scorer.spec)
        about |= {"spec": spec, "method": scorer.method, "warnings": list(scorer.warnings)}
        parts = scorer.parts if isinstance(scorer, CalibratedScorer) else [(scorer, None)]
        about["calibrators"] = [c.method if c else None for _, c in parts]
        for i, (part, calibrator) in enumerate(parts):
            _save(part.model, f"{path}/model-{i}")
            if calibrator is not None:
                _save(calibrator.model, f"{path}/calibrator-{i}")
    _write_text(spark, f"{path}/about", json.dumps(about, ensure_ascii=False))


def load(spark: SparkSession, path: str) -> Scorer | CalibratedScorer | Ensemble:
    about = _read_json(spark, f"{path}/about")
    if about["kind"] == "Ensemble":
        meta = load(spark, f"{path}/meta") if about["meta"] else None
        return Ensemble({n: load(spark, f"{path}/base-{n}") for n in about["base"]}, meta)
    spec = Spec(**about["spec"] | {"features": tuple(about["spec"]["features"])})
    warnings = tuple(about["warnings"])
    if about["kind"] == "Scorer":
        return Scorer(spec, _load_learner(spark, spec, f"{path}/model-0"), method=about["method"], warnings=warnings)
    parts = []
    for i, method in enumerate(about["calibrators"]):
        calibrator = Calibrator(method, _load(f"{path}/calibrator-{i}")) if method else None
        parts.append((Scorer(spec, _load_learner(spark, spec, f"{path}/model-{i}")), calibrator))
    return CalibratedScorer(spec, parts, about["method"], warnings)


def write_metrics(metrics: DataFrame, root: str, target: str, model: str) -> str:
    """A one-row metrics table where collect_metrics() finds it: <target>/<model>_metrics.json."""
    path = f"{root}/{target}/{model}_metrics.json"
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_manifest(
    spark: SparkSession, path: str, target: str, scorer, threshold: float, metrics: Mapping[str, object], features: DataFrame,
    metric: str = "f2",
) -> dict:
    """What a service needs to score: features with kinds and medians (from feature_metadata()),
    threshold, calibration, metrics and warnings; written as JSON and returned."""
    method = getattr(scorer, "method", None)
    rows = features.orderBy("feature").collect()  # one per feature
    manifest = {
        "schema_version": MANIFEST_VERSION,
        "target_version": target,
        "algorithm": scorer.spec.name if hasattr(scorer, "spec") else "+".join(scorer.base),
        "feature_names": list(scorer.spec.features) if hasattr(scorer, "spec") else [r["feature"] for r in rows],
        "feature_dtypes": {r["feature"]: r["dtype"] for r in rows},
        "feature_medians": {r["feature"]: r["median"] for r in rows},
        "imputation": {"strategy": "fill_median"},
        "prevalence_train": rows[0]["prevalence"] if rows else None,
        "n_train": rows[0]["n_total"] if rows else 0,
        "threshold": threshold,
        "threshold_metric": metric,
        "calibration": {"method": method, "calibrated": method is not None},
        "performance": dict(metrics),
        "warnings": list(getattr(scorer, "warnings", ())),
    }
    _write_text(spark, path, json.dumps(manifest, ensure_ascii=False))
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return _read_json(spark, path)
