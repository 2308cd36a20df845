"""Queries that run Python on the workers work from any working directory:
their code is pickled by value, the package need not be importable there."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
for name in ("sanitize_text",):
    print("ROWS", name, len(entry.queries()[name](spark, {SF_SMALL!r}).collect()))
"""


def test_python_worker_queries_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="ts-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert lines == ["ROWS sanitize_text 200"], out.stderr[-2000:]
