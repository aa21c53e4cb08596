"""Written tables and rounding."""

from __future__ import annotations

import math
import os
import random
import struct
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veilscan import session
from veilscan.operators.features import half_even

ROOT = str(Path(__file__).resolve().parent.parent)


def test_written_tables_are_read_and_removed(spark):
    out = session.written(spark.range(7), "seven")
    assert out.count() == 7
    path = session._places[id(out)].removeprefix("file:")
    assert path.startswith(session.shared_dir(spark).removeprefix("file:")) and os.path.isdir(path)
    session.dropped(out)
    assert not os.path.exists(path)
    session.dropped(spark.range(1))  # nothing to remove


def test_session_without_a_shared_folder(tmp_path):
    """A local session without spark.checkpoint.dir gets a folder, which goes with it; a cluster gets a clear error."""
    code = """
import os
from pyspark.sql import SparkSession
from veilscan import session
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert session.written(spark.range(3), "three").count() == 3
print("FOLDER", session.shared_dir(spark))
class Cluster:
    applicationId, master, getConf = "other", "spark://host:7077", spark.sparkContext.getConf
class Session:
    sparkContext, conf = Cluster(), spark.conf
try:
    session.shared_dir(Session())
except ValueError as e:
    print("REFUSED", e)
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=120, check=True)
    folder = next(x.split()[1] for x in done.stdout.splitlines() if x.startswith("FOLDER"))
    for _ in range(50):  # the JVM ends after Python has
        if not os.path.exists(folder):
            break
        time.sleep(0.1)
    assert "veilscan-" in folder and not os.path.exists(folder)
    assert "REFUSED spark.checkpoint.dir must name a folder" in done.stdout


@pytest.mark.parametrize("digits", [3, 4])
def test_rounding_is_pythons(spark, digits):
    r = random.Random(digits)
    values = [k / n for n in (1, 3, 7, 8, 16, 64, 999, 1000, 4000, 5000, 16000, 49_999) for k in (r.randrange(1, 3 * n + 2) for _ in range(250))]
    values += [(2 * k + 1) / (2 * 10**digits) for k in range(2500)] + [r.uniform(0, 10 ** r.randint(-5, 8)) for _ in range(4000)]
    near = [(2 * r.randrange(10**6) + 1) / (2 * 10**digits) for _ in range(1000)]
    values += [math.nextafter(v, s) for v in near for s in (0, math.inf)] + [-0.0625, -2.0005, 0.0]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", half_even(F.col("x"), digits).alias("y")).collect()
    assert len(got) > 10_000 or digits == 3
    bad = [(g.x, g.y, round(g.x, digits)) for g in got if struct.pack("d", g.y + 0.0) != struct.pack("d", round(g.x, digits) + 0.0)]
    assert not bad, bad[:5]
