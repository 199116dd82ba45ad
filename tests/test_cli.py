"""The command line runs a job end to end in its own process."""

from __future__ import annotations

import os
import subprocess
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_profile(spark):
    from mercato.session import ensure_checkpoint_dir
    from mercato.sources import files
    from mercato.sources.synth import synth_sales

    path = f"{ensure_checkpoint_dir(spark)}/cli-raw-{uuid.uuid4().hex}"
    files.write_table(synth_sales(spark.range(1, 101)).coalesce(1), path, "csv")
    out = subprocess.run(
        [sys.executable, "-m", "mercato", "profile", path, "--master", "local[2]"],
        cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "== overview" in out.stdout and "== revenue_rule" in out.stdout
    assert "|100      |12          |" in out.stdout  # 100 rows, 12 columns
