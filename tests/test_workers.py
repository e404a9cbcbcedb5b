"""Queries with Python functions run in workers that cannot import the repository."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
import __spark_entry__ as E
from duotier.session import local_session
spark = local_session(2)
spark.sparkContext.setLogLevel("ERROR")
for name in %r:
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_python_functions_travel_by_value(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    names = ["llm_error_mode", "score_udf"]
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT % (REPO, names)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert [x.split()[0] for x in out.stdout.splitlines() if x.split()[0] in names] == names, out.stderr[-2000:]


def test_error_mode_asks_once_per_prompt(spark, tmp_path):
    from duotier.operators import answers

    log = str(tmp_path / "calls")

    def answerer(prompts):
        for p in prompts:
            with open(log, "a") as f:
                f.write(p + "\n")
            if p.startswith("bad"):
                raise ValueError(p)
        return prompts

    df = spark.createDataFrame([(i, f"{'bad' if i % 5 == 0 else 'good'} {i}") for i in range(40)], "item_id long, prompt string")
    got = answers.answer(df, answerer, error_mode=True).collect()
    assert sum(r.error_message is not None for r in got) == 8
    assert sorted(open(log).read().split("\n")[:-1]) == sorted(r.prompt for r in df.collect())
