"""The artifact catalogue: found by other applications, committed last, built anew when the input changes."""

import os
import subprocess
import sys

import pytest

from glossa.artifacts import artifact, fingerprint, manifest, shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.range(5).write.parquet(f"{path}/documents.parquet")
    return path


def writer(spark, made):
    def build(path):
        made.append(path)
        spark.range(len(made)).write.parquet(path)

    return build


def test_built_once_and_again_after_a_change(spark, folder):
    made = []
    first = artifact(spark, "thing", folder, writer(spark, made))
    assert artifact(spark, "thing", folder, writer(spark, made)) == first and made == [first]
    assert artifact(spark, "other", folder, writer(spark, made)) != first
    before = fingerprint(spark, folder, ("documents",))
    spark.range(1).write.mode("append").parquet(f"{folder}/documents.parquet")
    assert fingerprint(spark, folder, ("documents",)) != before
    again = artifact(spark, "thing", folder, writer(spark, made))
    assert again != first and spark.read.parquet(again).count() == 3 and spark.read.parquet(first).count() == 1


def test_a_failed_build_is_not_found(spark, folder):
    def broken(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        artifact(spark, "broken", folder, broken)
    made = []
    assert artifact(spark, "broken", folder, writer(spark, made)) == made[0]


def test_the_first_of_two_builders_wins(spark, folder):
    inner = []

    def slow(path):
        spark.range(1).write.parquet(path)
        inner.append(artifact(spark, "race", folder, writer(spark, [])))  # another one commits meanwhile

    assert artifact(spark, "race", folder, slow) == inner[0]
    assert manifest(spark, f"{shared_folder(spark)}/artifacts/none.json") is None


OTHER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from glossa.artifacts import artifact
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
def build(path):
    raise SystemExit("built again")
print("FOUND", artifact(s, "shared", {folder!r}, build))
"""


def test_another_application_finds_it(spark, folder):
    made = []
    path = artifact(spark, "shared", folder, writer(spark, made))
    shared = path[: path.index("/artifacts/")]
    run = subprocess.run([sys.executable, "-c", OTHER.format(root=ROOT, shared=shared, folder=folder)], capture_output=True, text=True, timeout=200)
    assert f"FOUND {path}" in run.stdout, run.stderr[-2000:]
