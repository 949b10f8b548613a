"""Tasks of the core operators need no copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from loomtally.plans.catalog import QUERIES
for name in ("phrase_join", "posting_intersect", "nearest_center_table", "qa_grouped", "group_median_wide", "udaf_concat"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_workers_without_the_package(tmp_path):
    own = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=own, capture_output=True, text=True, timeout=600)
    assert done.stdout.endswith("done\n"), done.stderr[-3000:]
