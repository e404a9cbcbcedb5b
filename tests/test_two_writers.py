"""Two writers of the registry at once: no number twice, none left out, no row lost."""

from concurrent.futures import ThreadPoolExecutor

from duotier.models import registry
from duotier.sources import sinks


class _Model:
    """Stands for a fitted pipeline: saving it writes one row."""

    def __init__(self, spark):
        self.spark = spark

    def save(self, path):
        self.spark.range(1).write.parquet(path)


def test_twenty_registrations_of_two_writers(spark):
    root = spark.conf.get("duotier.root")
    spark.conf.set("duotier.root", root + "/two")
    try:

        def writer(name):
            got = []
            for i in range(10):
                v = registry.register(spark, _Model(spark), name, 0.5 + i / 100)
                registry.point_alias(spark, "Champion", v)
                got.append(v)
            return got

        with ThreadPoolExecutor(2) as pool:
            a, b = pool.map(writer, ("a", "b"))
        assert sorted(a + b) == list(range(1, 21))
        rows = registry.versions_table(spark).collect()
        assert sorted(r["version"] for r in rows) == list(range(1, 21))
        assert {r["version"] for r in rows if r["algorithm"] == "a"} == set(a)
        log = registry.alias_log_table(spark).collect()
        assert sorted(r["seq"] for r in log) == list(range(1, 21))
        last = max(log, key=lambda r: r["seq"])
        assert registry.current_aliases(registry.alias_log_table(spark)).first()["version"] == last["version"]
    finally:
        spark.conf.set("duotier.root", root)


def test_claims_go_on_from_the_start_given(spark):
    assert [sinks.claim(spark, "series", 5) for _ in range(3)] == [5, 6, 7]
    assert sinks.claim(spark, "series", 1) == 1 and sinks.claim(spark, "other", 5) == 5
