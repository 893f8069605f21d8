"""The entry module without the operators for training data, and without what they import."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from meterloom.plans.catalog import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries()), 'SQL', *sorted(e.oracle_sql()))"


def names(folder, before=""):
    done = subprocess.run(
        [sys.executable, "-B", "-c", before + SHOW], cwd=folder, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr
    found = done.stdout.split("NAMES ")[1].split()
    return found[: found.index("SQL")], found[found.index("SQL") + 1 :]


@pytest.fixture
def copy(tmp_path):
    """What is under version control of the library, without tests."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(
        f"{ROOT}/meterloom", tmp_path / "meterloom", ignore=shutil.ignore_patterns("__pycache__", "llm")
    )
    return tmp_path


def test_the_other_queries_stand_without_the_folder(copy):
    found, sql = names(copy)
    assert found == sorted(QUERIES) and sql == sorted(ORACLES)


def test_the_other_queries_stand_without_what_it_imports():
    hide = "import sys; sys.modules.update(tokenizers=None, public_tokenizers=None); "
    found, sql = names(ROOT, hide)
    assert found == sorted(QUERIES) and sql == sorted(ORACLES)
