"""The driver imports __spark_entry__ from its own working directory with a plain
session: nothing shipped to Python workers may need this package importable."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
assert E.entry(spark).count() > 0
rows = E.queries()["vectorised_name_key"](spark, "/root/testdata/sf0.001").collect()
assert rows and all(r.name_key is None or r.name_key == r.name_key.strip() for r in rows)
print("CONTRACT-OK")
"""


def test_entry_and_python_udf_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                             timeout=600)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-3000:]
