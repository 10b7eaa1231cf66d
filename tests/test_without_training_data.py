"""The rest works where the training-data subpackage and its tests are not there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_SAYS = """
import __spark_entry__ as registered
from harness.queries import QUERIES
from harness import oracle
assert set(registered.queries()) == set(QUERIES)
assert set(registered.oracle_sql()) == set(oracle.sql()) <= set(QUERIES)
print("works")
"""


def _copied(folder, *without):
    ignored = {".git", ".pytest_cache", "__pycache__", *without}
    keep_out = lambda place, names: [n for n in names if n in ignored]
    shutil.copytree(ROOT, folder, ignore=keep_out)
    return subprocess.run(
        [sys.executable, "-c", _SAYS], cwd=folder, capture_output=True, text=True, timeout=120,
        env=os.environ | {"PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"},
    )


def test_without_the_folders_and_the_pipeline(tmp_path):
    ran = _copied(tmp_path / "bare", "llm", "corpus_pipeline.py")
    assert ran.stdout == "works\n", ran.stderr


def test_without_the_folders_alone(tmp_path):
    ran = _copied(tmp_path / "left", "llm")
    assert ran.stdout == "works\n", ran.stderr
