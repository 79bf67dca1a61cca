"""Entries of the store are found by content, complete or not at all."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayline.sources.store import Store, file_status

ROOT = Path(__file__).resolve().parents[1]
SECOND = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as entry
from stayline.operators import models

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", "4").getOrCreate())
entry.MODEL_SETTINGS.update(trees=20, depth=5, rounds=5, boost_depth=3, leaves=5)

def no_fit(*a, **k):
    raise AssertionError("a model was fitted")

models.fit_sets = no_fit
for name in ("model_metrics", "model_roundtrip"):
    print(name, entry.queries()[name](spark, sys.argv[3]).count())
"""


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).write.parquet(path)
    return path


def test_built_once(spark, table):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert Store(spark, [table], {"a": 1}).table("x", build).count() == 3
    assert Store(spark, [table], {"a": 1}).table("x", build).count() == 3
    assert len(calls) == 1
    Store(spark, [table], {"a": 2}).table("x", build)
    assert len(calls) == 2


def test_a_changed_file_gives_a_new_key(spark, table):
    first = Store(spark, [table], {}).key
    assert Store(spark, [table], {}).key == first
    part = next(Path(table).glob("part-*.parquet"))
    os.utime(part, (1, 1))
    assert Store(spark, [table], {}).key != first
    shutil.copy(part, part.with_name("part-more.parquet"))
    assert len(file_status(spark, [table])) > 1


def test_an_entry_without_marker_is_made_again(spark, table):
    store = Store(spark, [table], {"b": 1})

    def broken(path):
        spark.range(2).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.folder("x", broken)
    assert not store.holds("x")
    assert store.table("x", lambda: spark.range(7)).agg(F.count(F.lit(1))).first()[0] == 7


def test_a_second_application_fits_nothing(spark, sf, pipe):
    pipe.metrics.collect()
    where = spark.conf.get("spark.checkpoint.dir")
    ran = subprocess.run([sys.executable, "-c", SECOND, str(ROOT), where, sf], capture_output=True, text=True, timeout=400)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert "model_metrics 4" in ran.stdout
