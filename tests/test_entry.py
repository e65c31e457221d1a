"""The library without the subpackage of the training-data pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert 'spend_report' in q and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)
assert o.keys() == q.keys()
"""


def test_entry_works_without_the_pipeline(tmp_path):
    """Also where corpus_pipeline.py stayed behind."""
    for kept in (True, False):
        copy = tmp_path / str(kept)
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "spark-warehouse"))
        if not kept:
            for name in os.listdir(copy):
                if name == "corpus_pipeline.py":
                    os.unlink(copy / name)
        done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
        assert done.returncode == 0, done.stderr
