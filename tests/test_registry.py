"""Registry round trip and the three entry points with table writes."""

from conftest import SF
from pyspark.sql import functions as F

from duotier import config as C
from duotier.models import registry
from duotier.models import score as S
from duotier.plans import flows, training
from duotier.session import bootstrap
from duotier.sources import adapters as A
from duotier.sources import sinks


def test_bootstrap_creates_and_uses_schema(spark):
    assert bootstrap(spark, "duotier_test") == "duotier_test"
    assert spark.catalog.currentDatabase() == "duotier_test"
    spark.sql("USE default")


def test_train_register_load_score_and_retrain(spark):
    docs = A.docs(spark, SF["tiny"])
    runs = training.train_and_register(spark, docs, size="compact")
    assert runs.count() == 3
    model, row = registry.load(spark, C.CHAMPION)
    assert row["version"] == 1
    run = registry.run_of(spark, C.CHAMPION).first()  # alias → version → run → parameters and metrics
    assert run["metrics"]["test_accuracy"] == row["accuracy"] and run["algorithm"] == row["algorithm"]
    assert {"feature_count", "class_count", "threshold", "algorithm"} <= set(run["params"])
    bands = sinks.read_table(spark, "model_bands").where(F.col("version") == 1)
    assert bands.count() == 5 and bands.agg(F.sum("n")).first()[0] == runs.first()["n_test"]
    out = model.transform(docs)
    assert out.count() == docs.count()
    # alias log is append-only: a second pointer supersedes the first
    registry.point_alias(spark, C.CHALLENGER, 1)
    cur = {r["alias"]: r["version"] for r in registry.current_aliases(registry.alias_log_table(spark)).collect()}
    assert cur == {C.CHAMPION: 1, C.CHALLENGER: 1}


def test_retrain_on_the_same_holdout_registers_a_new_version(spark):
    d = SF["tiny"]
    training.train_and_register(spark, A.labeled(spark, d), size="compact", only=["LogisticRegression"])
    classified = flows.classified_flow(A.scored(spark, d), A.responses(spark, d))
    line = training.monitor_and_retrain(
        spark, classified, A.corrections(spark, d), A.labeled(spark, d), size="compact", need=5, same_holdout=True
    )
    assert line.startswith("RETRAIN:YES|OLD_ACC:") and "|PROMOTED:" in line
    versions = registry.versions_table(spark).agg(F.max("version")).first()[0]
    assert versions >= 3
    made = registry.versions_table(spark).where(F.col("version") == versions).first()
    assert "corrections" in made["description"]
    run = registry.runs_table(spark).where(F.col("run_id") == made["run_id"]).first()
    assert int(run["params"]["corrected_ids"]) == A.corrections(spark, d).select("item_id").distinct().count()


def test_latest_compares_text_versions_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), ("2",), ("x",), (None,)], "version string")
    assert registry.latest(df).first()["latest_version"] == 10


def test_stored_threshold_gates_by_default(spark):
    d = SF["tiny"]
    v = registry.versions_table(spark).where("version = 1").first()
    row = v.asDict() | {"version": 900, "threshold": 0.5}
    sinks.append_table(spark.createDataFrame([row], registry.VERSION_SCHEMA), registry.VERSIONS)
    registry.point_alias(spark, C.CHAMPION, 900)
    flows.run_scoring(A.scored(spark, d), A.codes(spark, d), "answers_t", "classified_t")
    assert sinks.read_table(spark, "answers_t").count() == A.scored(spark, d).where("ml_confidence < 0.5").count()
    registry.point_alias(spark, C.CHAMPION, 1)


def test_scoring_run_writes_answers_then_output(spark):
    d = SF["tiny"]
    out = flows.run_scoring(A.scored(spark, d), A.codes(spark, d), "llm_responses", "classified_items")
    assert out.count() == A.scored(spark, d).count()
    stored = sinks.read_table(spark, "llm_responses")
    assert stored.count() == A.scored(spark, d).where(F.col("ml_confidence") < 0.85).count()


def test_scoring_runs_can_append_with_run_id(spark):
    d = SF["tiny"]
    n = A.scored(spark, d).count()
    for run in ("r1", "r2"):
        out = flows.run_scoring(A.scored(spark, d), A.codes(spark, d), "answers_log", "classified_log", run_id=run)
    assert out.count() == 2 * n
    keyed = sinks.read_table(spark, "answers_log")
    assert keyed.groupBy("item_id", "run_id").count().where("count > 1").count() == 0
    assert keyed.select("run_id").distinct().count() == 2
    assert {r["run_id"] for r in out.select("run_id").distinct().collect()} == {"r1", "r2"}


def test_monitor_exit_without_retrain(spark):
    d = SF["tiny"]
    classified = flows.classified_flow(A.scored(spark, d), A.responses(spark, d))
    few = A.corrections(spark, d).limit(3)
    line = training.monitor_and_retrain(spark, classified, few, A.labeled(spark, d), size="compact")
    assert line.startswith("RETRAIN:NO|AVG_CONF:") and line.endswith("|CORRECTIONS:3")


def test_table_helpers(spark):
    from duotier.operators.merge import classified_schema

    sinks.ensure_table(spark, "empty_out", classified_schema())
    assert sinks.read_table(spark, "empty_out").count() == 0
    df = spark.range(5)
    sinks.save_table(df, "five")
    sinks.append_table(df, "five")
    assert sinks.read_table(spark, "five").count() == 10
    _ = S


def test_end_to_end_with_a_trained_model(spark):
    """B → A with a real model: train, load the Champion, score, answer, store, evaluate."""
    from pyspark.ml import PipelineModel

    from duotier.operators import evaluate

    d = SF["tiny"]
    training.train_and_register(spark, A.labeled(spark, d), size="compact", only=["LogisticRegression"])
    model, row = registry.load(spark, C.CHAMPION)
    features, clf = PipelineModel(stages=model.stages[:-1]), model.stages[-1]
    new = A.items(spark, d).select("item_id", "vendor_name", "product_description", "unit_price", "currency")
    scored = S.score(new, features, clf, "2024-06-01 00:00:00", row["version"])
    out = flows.run_scoring(scored, A.codes(spark, d), "e2e_answers", "e2e_classified")
    assert out.count() == new.count()
    truth = A.scored(spark, d).select("item_id", "truth_code")
    ev = evaluate.evaluate(out, truth).first()
    assert ev["n"] == new.count() and ev["accuracy"] is not None


def test_catalog_table_overwrite_and_recreate_with_new_schema(spark):
    sinks.save_catalog_table(spark.range(3), "duotier_t1")
    assert spark.table("duotier_t1").count() == 3
    sinks.save_catalog_table(spark.range(2).withColumn("x", F.lit("a")), "duotier_t1", recreate=True)
    t = spark.table("duotier_t1")
    assert t.columns == ["id", "x"] and t.count() == 2
    spark.sql("DROP TABLE IF EXISTS duotier_t1")


def test_parquet_export(spark):
    import os
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="duotier-export-", dir="/tmp"), "out")
    sinks.export_parquet(spark.range(4), path)
    sinks.export_parquet(spark.range(2), path)  # overwrite
    assert spark.read.parquet(path).count() == 2
