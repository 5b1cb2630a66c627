"""The library without the training-data package."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_queries_without_the_training_data_package(tmp_path):
    shutil.copytree(ROOT / "rankloom", tmp_path / "rankloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / file).exists():
            shutil.copy(ROOT / file, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr
    n, with_sql = map(int, ran.stdout.split())
    assert n >= with_sql > 40
