"""The driver entry without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_operators(tmp_path):
    keep = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "*.json", "*.md")
    for removed in (keep, shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md")):
        copy = tmp_path / str(len(list(tmp_path.iterdir())))
        shutil.copytree(ROOT, copy, ignore=removed)
        code = "import __spark_entry__ as e; print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))"
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout
        assert int(out.split()[0]) > 200 and out.split()[1] == "0"
