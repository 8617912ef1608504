"""The driver's view: a plain session in another working directory.

Python workers must not need the repository on their path: functions sent to
mapInPandas carry their code.
"""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
import pandas as pd
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
from corpusmill.operators import qa
assert E.entry(spark).count() > 0
assert E.queries()["blocks_nested"](spark, "/root/testdata/sf0.001").count() > 0
assert E.queries()["page_text_nested"](spark, "/root/testdata/sf0.001").count() > 0
df = spark.createDataFrame([("a. b.",)], "context string")
gen = lambda pdf: pd.DataFrame({{"question": pdf["context"], "answer": pdf["context"]}})
assert qa.generate_qa(df, gen).first().question == "a. b."
print("OK")
"""


def test_plain_session_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(),
                         capture_output=True, text=True, timeout=600, env=env)
    assert out.stdout.strip().endswith("OK"), out.stderr[-3000:]
