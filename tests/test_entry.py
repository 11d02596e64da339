"""The entry module works where the training-data package is not there."""
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_package(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    env = os.environ | {"PYTHONPATH": str(tmp_path / "repo")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, check=True)
    n, m, there = out.stdout.split()
    assert int(n) == int(m) > 40 and there == "False"
