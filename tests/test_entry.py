"""The entry with and without the training-data files."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def run(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


@pytest.fixture
def copy(tmp_path):
    shutil.copytree(os.path.join(REPO, "docloom"), tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    return tmp_path


def test_without_the_training_data_files(copy):
    out = run(copy)
    assert out.returncode == 0, out.stderr
    assert "tier_distribution" in out.stdout and "op1_" not in out.stdout and "pipeline" not in out.stdout


def test_an_error_inside_them_is_not_swallowed(copy):
    (copy / "docloom" / "llm").mkdir()
    (copy / "docloom" / "llm" / "__init__.py").write_text("")
    (copy / "docloom" / "llm" / "catalog.py").write_text("from docloom.llm import nothing_of_this_name\n")
    out = run(copy)
    assert out.returncode != 0 and "nothing_of_this_name" in out.stderr
