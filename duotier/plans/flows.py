"""The scoring run as one lazy plan over DataFrames (entry point A, model-free part).

    scored → {accept, route}; route → answers → parse → fallback;
    accept ∪ resolved → conform → classified

`classified_flow` returns the lazy result; `run_scoring` also writes the scored
rows, the stored answers and the output table (three materialisation points in
the shared storage, no driver collect).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import config as C
from ..config import COLS, Cols
from ..operators import answers, gate, ledger, merge

RUN_TS = "2024-06-01 00:00:00"
MODEL_VERSION = "1"


def resolved_flow(scored: DataFrame, responses: DataFrame, t: float = C.CONFIDENCE_THRESHOLD, cols: Cols = COLS) -> DataFrame:
    routed = gate.route(scored, t, cols)
    return answers.fallback(routed, answers.parse(responses, cols.id), cols=cols)


def classified_flow(
    scored: DataFrame,
    responses: DataFrame,
    t: float = C.CONFIDENCE_THRESHOLD,
    run_ts: str = RUN_TS,
    model_version: str = MODEL_VERSION,
    cols: Cols = COLS,
) -> DataFrame:
    accepted = gate.accept(scored, t, cols)
    resolved = resolved_flow(scored, responses, t, cols)
    return merge.merge(accepted, resolved, run_ts, model_version, cols)


def run_scoring(
    scored: DataFrame,
    codes: DataFrame,
    answers_table: str,
    output_table: str,
    answerer=None,
    t: float | None = None,
    run_ts: str = RUN_TS,
    model_version: str = MODEL_VERSION,
    cols: Cols = COLS,
    run_id: str | None = None,
    ledger_table: str | None = None,
) -> DataFrame:
    """Score, answer routed rows once, store the answers, merge and store the output.

    Default: the output table is replaced each run.  With `run_id`, rows get a
    `run_id` column and only that run's rows are replaced, so earlier runs stay
    visible to monitoring and a run can be repeated.

    `t=None` gates at the threshold registered with the Champion, or the configured one without a Champion.
    Stored answers are keyed by item and run.

    `answerer=None` uses the bundled lexical answerer; otherwise a callable over
    a pandas Series of prompts (run in error mode).  Answers are written
    before they are parsed so a re-read never calls the model again.  With
    `ledger_table` and `run_id`, a run that failed and is started again asks only
    what it has no answer to (`operators/ledger.py`)."""
    from pyspark.sql import functions as F

    from ..models import registry
    from ..sources import sinks

    spark = scored.sparkSession
    if ledger_table and not run_id:
        raise ValueError("a ledger is kept by run: give a run_id")
    if t is None:
        stored_t = registry.stored_threshold(spark)
        t = C.CONFIDENCE_THRESHOLD if stored_t is None else stored_t
    # the scored rows feed both branches: write them once (the model runs once,
    # and a lost executor re-reads the table instead of re-scoring)
    scored_table = f"{output_table}__scored" + (f"_{run_id}" if run_id else "")
    sinks.save_table(scored, scored_table)
    scored = sinks.read_table(spark, scored_table)
    routed = gate.route(scored, t, cols)
    if answerer is None:
        ans = answers.lexical_answers(routed, codes, cols)
    elif ledger_table:
        ans = ledger.ask(answers.prompts(routed, codes, cols), answerer, ledger_table, run_id, id_col=cols.id)
        ans = ans.drop(ledger.DIGEST)
    else:
        ans = answers.answer(answers.prompts(routed, codes, cols), answerer, error_mode=True, id_col=cols.id)
    stored = _store(ans, answers_table, run_id)
    if run_id:
        stored = stored.where(F.col("run_id") == run_id).drop("run_id")
    out = merge.merge(
        gate.accept(scored, t, cols),
        answers.fallback(routed, answers.parse(stored, cols.id), cols=cols),
        run_ts,
        model_version,
        cols,
    )
    return _store(out, output_table, run_id)


def _store(df: DataFrame, table: str, run_id: str | None) -> DataFrame:
    """The table after `df` was written to it: whole, or as the rows of one run."""
    from pyspark.sql import functions as F

    from ..sources import sinks

    if run_id is None:
        sinks.save_table(df, table)
    else:
        df = df.withColumn("run_id", F.lit(run_id))
        sinks.replace_parts(df, table, "run_id")
    return sinks.read_table(df.sparkSession, table, df.schema)
