"""The entry points on a copy of the sources, with and without the corpus folders."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from berth.plans import catalogue

ROOT = Path(__file__).resolve().parent.parent
SOURCES = ["__spark_entry__.py", "corpus_pipeline.py", "berth"]
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("gone", [["berth/llm", "corpus_pipeline.py"], ["berth/llm"]])
def test_imports_without_the_corpus_folders(tmp_path, gone):
    for name in SOURCES:
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        elif source.exists() and name not in gone:
            shutil.copy(source, tmp_path / name)
    done = subprocess.run(
        [sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(catalogue.QUERIES)), str(len(catalogue.SQL)), "False"]
