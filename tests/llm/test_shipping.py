"""Executors without a copy of the repository: another working directory, no PYTHONPATH, the package found by the driver alone."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, {ROOT!r})
import __spark_entry__
from pyspark.sql import functions as F

def missing(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("flamequarry") is None])], names=["missing"])

assert spark.range(1).mapInArrow(missing, "missing boolean").first()[0]
queries = __spark_entry__.queries()
for name in ("op1_minhash_near_dedup", "op4_chat_format", "op7_lm_scores", "op8_sentencepiece", "op10_decontaminate", "pipeline"):
    print(name, queries[name](spark, "/root/testdata/sf0.001").count())
from flamequarry.llm import decontaminate
from flamequarry.llm.common import table
docs, items = (table(spark, "/root/testdata/sf0.001", n) for n in ("documents", "benchmark"))
print("joined", decontaminate.contamination(docs, items, block=10).count())
"""


def test_workers_need_no_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "op10_decontaminate 200" in out.stdout and "joined 200" in out.stdout and "pipeline" in out.stdout
