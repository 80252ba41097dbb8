"""Every text query on workers that cannot import the package."""

import os
import subprocess
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.append({root!r})
import __spark_entry__ as entry
from gridtide.session import build_session
from pyspark.sql import functions as F, types as T

spark = build_session("apart", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")

@F.udf(T.BooleanType())
def known(x):
    try:
        __import__("gridtide")
        return True
    except ModuleNotFoundError:
        return False

assert not spark.range(1).select(known("id")).first()[0], "the workers have the package"
for name in entry.TEXT_QUERIES:
    print(name, entry.TEXT_QUERIES[name](spark, {folder!r}).count(), flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_queries_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME", "PYSPARK_SUBMIT_ARGS", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, folder=FOLDER)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
    names = {line.split()[0] for line in run.stdout.splitlines() if line.startswith(("op", "pipeline"))}
    assert len(names) == 14
