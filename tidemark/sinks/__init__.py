"""Sinks (K1-K4) and the model store it shares with the model source."""

from __future__ import annotations

import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models import BgNbdParams, CoxParams, GammaGammaParams

log = logging.getLogger(__name__)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1/K2: header CSV export (one folder of part files; no driver collect)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_responses(responses: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one JSON response body per request, as text lines."""
    responses.select("body").write.mode(mode).text(path)


def _rows(bundle) -> list[tuple[str, str, float]]:
    rows: list[tuple[str, str, float]] = []
    if bundle.bgnbd is not None:
        rows += [("bgnbd", k, float(v)) for k, v in bundle.bgnbd.as_dict().items()]
    if bundle.gamma_gamma is not None:
        rows += [("gamma_gamma", k, float(v)) for k, v in bundle.gamma_gamma.as_dict().items()]
    cox_models = {"cox": bundle.cox} if bundle.cox is not None else {}
    cox_models.update({f"cox[{g}]": m for g, m in (bundle.cox_by_channel or {}).items()})
    for name, m in cox_models.items():
        for f, c, mu in zip(m.features, m.coef, m.mean):
            rows += [(name, f"coef:{f}", float(c)), (name, f"mean:{f}", float(mu))]
    return rows


def save_models(spark: SparkSession, bundle, path: str, metrics: DataFrame | None = None) -> None:
    """K4: parameters as a JSON table (model, name, value), Cox baselines as
    parquet (model, time, cumulative_hazard), metrics as JSON, plus a small
    config file naming the parts. Overwrites."""
    params = spark.createDataFrame(_rows(bundle), "model string, name string, value double")
    params.coalesce(1).write.mode("overwrite").json(os.path.join(path, "params"))
    base = []
    cox_models = {"cox": bundle.cox} if bundle.cox is not None else {}
    cox_models.update({f"cox[{g}]": m for g, m in (bundle.cox_by_channel or {}).items()})
    for name, m in cox_models.items():
        base += [(name, float(t), float(h)) for t, h in m.baseline]
    spark.createDataFrame(base, "model string, time double, cumulative_hazard double") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "baseline"))
    if metrics is not None:
        metrics.coalesce(1).write.mode("overwrite").json(os.path.join(path, "metrics"))
    cfg = {"models": {"params": "params", "baseline": "baseline", "metrics": "metrics"}, **(bundle.config or {})}
    spark.createDataFrame([(json.dumps(cfg),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "model_config"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def load_models(spark: SparkSession, path: str):
    """Read a model store. Only a missing path, or a model that was not
    saved, leaves that model unset (the scoring fallbacks apply, with a
    warning); a store that is there but damaged is an error. The training's
    snapshot, horizon and penalizer come back as ``config``."""
    from ..plans.models import ModelBundle
    b = ModelBundle()
    p_path = os.path.join(path, "params")
    if not _exists(spark, p_path):
        log.warning("no model parameters at %s; using fallbacks", p_path)
        return b
    params = spark.read.schema("model string, name string, value double").option("mode", "FAILFAST").json(p_path).collect()
    cfg = os.path.join(path, "model_config")
    if _exists(spark, cfg):
        b.config = {k: v for k, v in json.loads("".join(r[0] for r in spark.read.text(cfg).collect())).items() if k != "models"}
    by: dict[str, dict[str, float]] = {}
    for r in params:
        by.setdefault(r["model"], {})[r["name"]] = r["value"]
    base_rows = spark.read.schema("model string, time double, cumulative_hazard double").parquet(os.path.join(path, "baseline")).collect()
    baselines: dict[str, list] = {}
    for r in base_rows:
        baselines.setdefault(r["model"], []).append((r["time"], r["cumulative_hazard"]))
    if "bgnbd" in by:
        b.bgnbd = BgNbdParams(**{k: by["bgnbd"][k] for k in ("r", "alpha", "a", "b")})
    else:
        log.warning("BG/NBD model not found in %s", path)
    if "gamma_gamma" in by:
        b.gamma_gamma = GammaGammaParams(**{k: by["gamma_gamma"][k] for k in ("p", "q", "v")})
    else:
        log.warning("Gamma-Gamma model not found in %s", path)
    for name, vals in by.items():
        if not name.startswith("cox"):
            continue
        if not baselines.get(name):
            raise ValueError(f"{path}: {name} has no baseline")
        feats = sorted(k.split(":", 1)[1] for k in vals if k.startswith("coef:"))
        m = CoxParams(features=tuple(feats), coef=tuple(vals[f"coef:{f}"] for f in feats),
                      mean=tuple(vals[f"mean:{f}"] for f in feats),
                      baseline=tuple(sorted(baselines.get(name, []))))
        if name == "cox":
            b.cox = m
        else:
            b.cox_by_channel[name[4:-1]] = m
    if b.cox is None:
        log.warning("Cox model not found in %s", path)
    return b


def read_csv_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


__all__ = ["write_csv", "write_responses", "save_models", "load_models", "read_csv_back", "F"]
