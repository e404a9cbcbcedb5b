"""Resumable answers: killed tasks, repeated prompts, errors, hot prompts."""

import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from duotier.operators import ledger
from duotier.plans import flows
from duotier.sources import adapters as A
from duotier.sources import sinks

from conftest import SF


def _prompts(spark, n_items, n_prompts):
    text = F.concat(F.lit("prompt "), (F.col("id") % n_prompts).cast("string"))
    return spark.range(n_items).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"), text.alias("prompt"))


def _counting(folder, kill=False):
    """An answerer that notes each prompt it answers; with `kill`, half of the workers die before they ask."""

    def run(texts):
        import os
        import time
        import uuid
        import zlib

        if kill and zlib.crc32(texts.iloc[0].encode()) % 2:
            time.sleep(6)  # so that the others have ended
            os._exit(1)
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(texts))
        return texts.map(lambda t: '{"iso_code":"%s","reason":"r","agrees_with_ml":true}' % t)

    return run


def _calls(folder):
    return Counter(t for name in os.listdir(folder) for t in open(f"{folder}/{name}").read().split("\n"))


def test_rerun_asks_only_what_killed_tasks_left(spark):
    folder = tempfile.mkdtemp(prefix="duotier-calls-", dir="/tmp")
    prompts = _prompts(spark, 400, 80)
    with pytest.raises(Exception):
        ledger.ask(prompts, _counting(folder, kill=True), "led", "r1", error_mode=False, batch=10).count()
    first = _calls(folder)
    kept = {r[ledger.DIGEST] for r in ledger.entries(spark, "led", "r1").collect()}
    assert 0 < len(kept) < 80
    out = ledger.ask(prompts, _counting(folder), "led", "r1", error_mode=False, batch=10).collect()
    assert len(out) == 400 and all(r["response"] for r in out)
    calls = _calls(folder)
    assert set(calls) == {f"prompt {i}" for i in range(80)}
    # what was committed before the kill was not asked again
    digests = {r["prompt"]: r[ledger.DIGEST] for r in ledger.with_digest(prompts).collect()}
    assert all(calls[p] == 1 for p in calls if digests[p] in kept or p not in first)
    assert sum(calls.values()) - 80 == sum(1 for p in first if digests[p] not in kept)
    before = sum(calls.values())
    ledger.ask(prompts, _counting(folder), "led", "r1", batch=10).count()
    assert sum(_calls(folder).values()) == before  # a third start asks nothing
    ledger.ask(prompts.limit(3), _counting(folder), "led", "r2", batch=10).count()
    assert sum(_calls(folder).values()) == before + 3  # another run is another key


def test_an_error_is_asked_again_and_an_answer_wins(spark):
    prompts = _prompts(spark, 6, 3)

    def fails_on_one(texts):
        if texts.iloc[0] == "prompt 1":
            raise ValueError("busy")
        return texts

    out = ledger.ask(prompts, fails_on_one, "led_err", "2024-06-01 00:00/a").collect()
    assert {r["error_message"] for r in out if r["response"] is None} == {"ValueError: busy"}
    assert sum(r["response"] is None for r in out) == 2
    out = ledger.ask(prompts, lambda t: t + "!", "led_err", "2024-06-01 00:00/a").collect()
    assert sorted(r["response"] for r in out) == ["prompt 0", "prompt 0", "prompt 1!", "prompt 1!", "prompt 2", "prompt 2"]
    assert all(r["error_message"] is None for r in out)


def test_hot_prompt_and_no_rows(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    prompts = ledger.with_digest(spark.range(3000).select(F.col("id").alias("item_id"), hot.alias("prompt")))
    entries = prompts.where("item_id < 1500").select(ledger.DIGEST, F.col("prompt").alias("response"),
                                                     F.lit(None).cast("string").alias("error_message"))
    out = {r["item_id"]: r["response"] for r in ledger.to_items(prompts, entries).collect()}
    assert out == {i: "hot" if i % 3 == 0 else str(i) if i < 1500 else None for i in range(3000)}
    assert ledger.pending(prompts, entries).count() == 1000
    none = ledger.ask(_prompts(spark, 0, 1), lambda t: t, "led_none", "r")
    assert none.count() == 0


def test_scoring_run_with_a_ledger_can_be_repeated(spark):
    d = SF["tiny"]
    folder = tempfile.mkdtemp(prefix="duotier-calls-", dir="/tmp")
    for _ in range(2):
        out = flows.run_scoring(A.scored(spark, d), A.codes(spark, d), "led_answers", "led_classified",
                                answerer=_counting(folder), run_id="7", ledger_table="led_flow")
    assert out.count() == A.scored(spark, d).count()
    routed = A.scored(spark, d).where(F.col("ml_confidence") < 0.85).count()
    assert sum(1 for name in os.listdir(folder)) == routed  # error mode: a call per distinct prompt, in the first run only
    assert sinks.read_table(spark, "led_answers").count() == routed
    with pytest.raises(ValueError):
        flows.run_scoring(A.scored(spark, d), A.codes(spark, d), "a", "b", ledger_table="led_flow")
