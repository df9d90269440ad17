"""The driver's entry in a copy of the repository without the optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import __spark_entry__ as e
from cohortspark.plans import catalog
assert set(e.queries()) == set(catalog.queries()) and len(e.queries()) > 100
assert e.oracle_sql() == catalog.oracle_sql()
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    assert not (tmp_path / "copy/cohortspark/llm").exists()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CHECK], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr


def test_other_missing_modules_are_not_forgiven(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", "__pycache__", ".git"))
    (tmp_path / "copy/corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert run.returncode != 0 and "no_such_module_at_all" in run.stderr
