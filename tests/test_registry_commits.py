"""Registrations at one time get different versions; unfinished ones don't exist."""
from concurrent.futures import ThreadPoolExecutor

import pytest

from tessera.operators import registry as R


def rows(spark, *names):
    return spark.createDataFrame([(n, f"run-{i}") for i, n in enumerate(names)], "model string, run string")


def test_concurrent_registrations_get_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: R.register(path, rows(spark, "m"), "model").first().version, range(12)))
    assert sorted(got) == list(range(1, 13))
    assert [n for n, _ in R.commits(spark, path)] == list(range(1, 13))


def test_versions_count_by_model_in_commit_order(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert {(r.model, r.version) for r in R.register(path, rows(spark, "a", "b", "a"), "model").collect()} == {("a", 1), ("a", 2), ("b", 1)}
    assert {(r.model, r.version) for r in R.register(path, rows(spark, "b", "c"), "model").collect()} == {("b", 2), ("c", 1)}
    assert R.registrations(spark, path, "model").count() == 5
    # a writer that fails before its commit leaves nothing to see
    rows(spark, "a").write.parquet(f"{path}/data/halfway")
    assert R.registrations(spark, path, "model").count() == 5


def test_a_taken_number_is_refused(spark, tmp_path):
    path = str(tmp_path / "x" / "0001")
    assert R._create_if_absent(spark, path, "one") and not R._create_if_absent(spark, path, "two")
    assert open(path).read() == "one"
    with pytest.raises(FileNotFoundError):
        R.registrations(spark, str(tmp_path / "none"), "model")
