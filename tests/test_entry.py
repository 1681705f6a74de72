"""The driver's entry, with and without the corpus operators."""

import os
import subprocess
import sys
from pathlib import Path

from conftest import SMALL

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_else_imports_llm():
    for path in (ROOT / "terrane").rglob("*.py"):
        if "llm" not in path.parts:
            assert "terrane.llm" not in path.read_text()


def test_entry_without_llm(tmp_path):
    import shutil

    shutil.copytree(ROOT / "terrane", tmp_path / "terrane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"
    code += "\nfrom pyspark.sql import SparkSession\nspark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()"
    code += f"\nassert all(q[n](spark, '{SMALL}').count() > 0 for n in ('median_region', 'categories_of_urls'))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
