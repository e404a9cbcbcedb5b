"""Training, comparison, retraining and promotion (entry points B and C).

`compare_models` and `retrain_model` are pure (they return DataFrames);
`train_and_register` / `monitor_and_retrain` add the registry writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..models import models as M
from ..models import registry
from ..models.features_ml import fit_features, label_names, stage
from ..operators import gate
from ..operators.features import split_strat
from ..session import has_storage
from ..sources import sinks


def prepare(df: DataFrame, frac: float, fit_on: str = "all", cols: Cols = COLS, vocab_size: int = C.VOCAB_SIZE):
    """Stratified split, then features fitted on all rows (default) or train rows only."""
    # every feature stage is fitted on these rows, so they are computed once
    d = split_strat(df, cols.label, frac, id_col=cols.id).persist()
    few = M.in_few_parts(d, d.count())  # each pass over the texts is a task, and a Python worker's, per part
    fit_rows = few if fit_on == "all" else few.where(~F.col("is_test"))
    fm = fit_features(fit_rows, cols, vocab_size)
    return fm, fm.transform(few), d


def compare_models(
    labeled: DataFrame, size: str = "full", frac: float = C.TRAIN_TEST_FRACTION, fit_on: str = "all",
    only: list[str] | None = None, cols: Cols = COLS,
):
    """(runs, fitted, features_model): every candidate on one cached feature frame."""
    runs, fitted, fm, feats = _compare(labeled, size, frac, fit_on, only, cols)
    feats.unpersist()
    return runs, fitted, fm


def compare_with_holdout(
    labeled: DataFrame, size: str = "full", frac: float = C.TRAIN_TEST_FRACTION, fit_on: str = "all",
    only: list[str] | None = None, cols: Cols = COLS,
):
    """As `compare_models`, and the holdout's features and labels, which stay cached: nothing is tokenised again for them."""
    runs, fitted, fm, feats = _compare(labeled, size, frac, fit_on, only, cols)
    holdout = feats.where("is_test").select("features", "label").persist()
    holdout.count()  # taken from the cached features
    feats.unpersist()
    return runs, fitted, fm, holdout


def _compare(labeled: DataFrame, size: str, frac: float, fit_on: str, only: list[str] | None, cols: Cols):
    fm, feats, split = prepare(labeled, frac, fit_on, cols)
    feats = feats.select("features", "label", "is_test").persist()
    n_train = feats.where(~F.col("is_test")).count()
    split.unpersist()
    spark = labeled.sparkSession
    est = M.candidates(n_train, size, keep_nodes=bool(spark.sparkContext.getCheckpointDir()), storage=has_storage(spark))
    if only:
        est = {k: v for k, v in (est | M.extra_candidates(size)).items() if k in only}
    runs, fitted = M.compare(M.in_few_parts(feats, n_train), F.col("is_test"), est)
    return runs, fitted, fm, feats


def winner_bands(runs: DataFrame, fitted: dict, holdout: DataFrame) -> tuple[str, DataFrame]:
    """The best candidate's name, and the confidence bands of its holdout predictions, not rounded."""
    best = registry.select_best(runs.withColumn("version", F.col("ordinal"))).first()["best_algorithm"]
    bands = gate.bands(M.confidence(fitted[best].transform(holdout)), "confidence").cache()
    bands.count()  # a row per band
    holdout.unpersist()
    return best, bands


def retrain_model(augmented: DataFrame, size: str = "full", algorithm: str = "RandomForest", cols: Cols = COLS):
    """Refit features and one model on the augmented set, 20 % holdout."""
    runs, fitted, fm = compare_models(augmented, size, C.RETRAIN_TEST_FRACTION, only=[algorithm], cols=cols)
    return runs, fitted[algorithm], fm


def train_and_register(
    spark, labeled: DataFrame, size: str = "full", cols: Cols = COLS, only: list[str] | None = None
) -> DataFrame:
    """Compare, register the best as a new version and point Champion at it."""
    from pyspark.ml import PipelineModel

    runs, fitted, fm, holdout = compare_with_holdout(labeled, size, cols=cols, only=only)
    shape = {
        "feature_count": _feature_count(fm), "class_count": len(label_names(fm)),
        "threshold": C.CONFIDENCE_THRESHOLD, "size": size,
    }
    ids = {}
    for r in runs.collect():  # one row per candidate
        ids[r["algorithm"]] = registry.log_run(
            spark, r["algorithm"], {"algorithm": r["algorithm"], **shape},
            {"test_accuracy": r["accuracy"], "avg_confidence": r["avg_confidence"],
             "low_confidence_pct": r["low_confidence_pct"]},
        )
    best = registry.select_best(runs.withColumn("version", F.col("ordinal"))).first()
    name = best["best_algorithm"]
    model = PipelineModel(stages=[*fm.stages, M.as_stage(spark, fitted[name])])
    v = registry.register(spark, model, name, best["best_accuracy"], run_id=ids[name])
    registry.point_alias(spark, C.CHAMPION, v)
    _, bands = winner_bands(runs, fitted, holdout)
    sinks.append_table(bands.withColumns({"version": F.lit(v), "run_id": F.lit(ids[name])}), "model_bands")
    return runs


def _feature_count(fm) -> int:
    """Length of the feature vector: vocabulary, vendors and the price."""
    text, vendors = stage(fm, "_tf"), stage(fm, "_vendor_ix")
    return len(text.vocabulary) + len(vendors.labels) + 1


def monitor_and_retrain(
    spark,
    classified: DataFrame,
    corrections: DataFrame,
    labeled: DataFrame,
    size: str = "full",
    need: int = C.MIN_CORRECTIONS,
    algorithm: str = "RandomForest",
    cols: Cols = COLS,
    same_holdout: bool = False,
) -> str:
    """Entry point C: signals → decision; if needed, retrain on the augmented set,
    register the new version and move Champion (not worse) or Challenger to it.

    By default the new model's holdout accuracy is compared with the accuracy
    recorded for the Champion (on its own holdout).  `same_holdout=True` scores
    the Champion on the new model's holdout rows instead.
    Returns the status line.  The only driver reads are one-row results."""
    from pyspark.ml import PipelineModel

    from ..operators import monitor, retrain

    sig = monitor.signals(classified, cols=cols)
    dec = monitor.decision(monitor.drift_flags(sig), corrections, need)
    if not dec.select("retrain").first()[0]:
        return monitor.status_line(sig, dec).first()["status"]
    augmented = retrain.augment(labeled, classified, corrections, cols=cols)
    runs, model, fm = retrain_model(augmented, size, algorithm, cols)
    champion = registry.resolve(
        registry.current_aliases(registry.alias_log_table(spark)), registry.versions_table(spark), C.CHAMPION
    ).select("accuracy")
    if same_holdout and champion.limit(1).count():
        holdout = split_strat(augmented, cols.label, C.RETRAIN_TEST_FRACTION, id_col=cols.id).where("is_test")
        champion = holdout_accuracy(spark, C.CHAMPION, holdout, cols)
    promo = retrain.promotion(runs.select("accuracy"), champion).first()
    flags = monitor.drift_flags(sig).first()  # one row
    fired = {"avg_confidence": "conf_drift", "fallback_pct": "volume_drift"}
    signals = {name: round(flags[name], 4) for name, flag in fired.items() if flags[flag]}
    n_rows = augmented.count()
    n_ids = corrections.agg(F.countDistinct(cols.id)).first()[0]
    run_id = registry.log_run(
        spark, algorithm,
        {"estimator": algorithm, "fit_rows": n_rows, "corrected_ids": n_ids, "gate": C.CONFIDENCE_THRESHOLD, **signals},
        {"holdout_accuracy": promo["new_accuracy"]},
    )
    because = ", ".join(f"{name} at {value}" for name, value in signals.items())
    v = registry.register(
        spark, PipelineModel(stages=[*fm.stages, M.as_stage(spark, model)]), algorithm, promo["new_accuracy"],
        description=f"{algorithm} fitted to {n_rows} items, codes of {n_ids} ids taken from corrections, because of {because}",
        run_id=run_id,
    )
    registry.point_alias(spark, C.CHAMPION if promo["promoted"] else C.CHALLENGER, v)
    p = spark.createDataFrame([(promo["old_accuracy"], promo["new_accuracy"], promo["promoted"])],
                              "old_accuracy double, new_accuracy double, promoted boolean")
    return monitor.status_line(sig, dec, p).first()["status"]


def holdout_accuracy(spark, alias: str, rows: DataFrame, cols: Cols = COLS) -> DataFrame:
    """One row: accuracy of the model behind `alias` on `rows` (labelled by `cols.label`)."""
    from pyspark.ml import PipelineModel

    from ..functions.text import exact_ratio
    from ..models.score import score

    full, _ = registry.load(spark, alias)
    features_model, model = PipelineModel(stages=full.stages[:-1]), full.stages[-1]
    scored = score(rows, features_model, model, "1970-01-01 00:00:00", alias, cols)
    ok = F.coalesce(F.col(cols.predicted) == F.col(cols.label), F.lit(False))
    return scored.agg(exact_ratio(F.count_if(ok), F.count(F.lit(1))).alias("accuracy"))
