"""The entry points with and without the training-data package."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(len(e.queries()), sum(q.startswith('op') and q[2].isdigit() for q in e.queries()), 'pipeline' in e.queries())"


def said(folder):
    made = subprocess.run([sys.executable, "-c", SAYS], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True, check=True)
    total, numbered, pipeline = made.stdout.split()
    return int(total), int(numbered), pipeline == "True"


def test_entry_without_the_package(tmp_path):
    shutil.copytree(os.path.join(REPO, "shoptrail"), tmp_path / "shoptrail", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), tmp_path)
    total, numbered, pipeline = said(tmp_path)
    assert total > 150 and numbered == 0 and not pipeline
