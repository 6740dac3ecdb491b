"""The driver imports __spark_entry__ from elsewhere: Python workers must still import the package."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as ent
assert ent.entry(spark).count() > 0
q = ent.queries()
assert q["ld_pairs_panels"](spark, "/root/testdata/sf0.001").count() >= 0
assert q["score_corr_pvalue"](spark, "/root/testdata/sf0.001").count() > 0
print("OK")
"""


def test_entry_and_python_udfs_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="polyscore-foreign-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=900)
    assert r.returncode == 0 and "OK" in r.stdout, r.stderr[-3000:]
