"""The engine under a session it did not configure (as the driver runs it)."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
     .config("spark.sql.session.timeZone", "Asia/Kolkata").getOrCreate())
s.sparkContext.setLogLevel("ERROR")
from mercato.session import ensure_checkpoint_dir
from mercato.plans.registry import all_queries
d = ensure_checkpoint_dir(s)
assert d == ensure_checkpoint_dir(s)
q = all_queries()
print("rows", q["clean_report"].fn(s, "/root/testdata/sf0.001").count(),
      q["surrogate_keys_customer"].fn(s, "/root/testdata/sf0.001").count(),
      q["windowed_metrics"].fn(s, "/root/testdata/sf0.001").count())
print("partitions", s.conf.get("spark.sql.shuffle.partitions"))
"""


def test_runs_without_checkpoint_dir_or_defaults():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="noconf-"))
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT)], env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows 7 150 " in out.stdout
    assert "partitions 200" in out.stdout
