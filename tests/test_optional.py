"""The text operators may be missing: all else goes on without them."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_text_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; from tillflow.plans.queries import QUERIES; " \
           "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) < set(QUERIES)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True)
