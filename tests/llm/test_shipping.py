"""Tasks need no copy of the package: objects and functions travel to workers without its path."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
def packages(batches):
    import importlib.util, pandas
    for _ in batches:
        yield pandas.DataFrame({{"found": [importlib.util.find_spec("loomtally") is not None]}})
assert not any(r.found for r in spark.range(4).mapInPandas(packages, "found boolean").collect())
from loomtally.llm.queries import QUERIES
for name in {names!r}:
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
print("done")
"""


@pytest.mark.parametrize("names", [
    ["op3_license_scan", "op4_byte_bpe", "op5_decontaminate"], ["op6_language_id", "op10_ann_tree", "op11_periodic_runs"],
    ["op12_collocations", "op13_warc"],
])
def test_workers_without_the_package(tmp_path, names):
    own = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME_PYTHONPATH")}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT), names=names))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=own, capture_output=True, text=True, timeout=600)
    assert done.stdout.endswith("done\n"), done.stderr[-3000:]
