"""The entry point with and without the parts that an installation may leave out."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from tidemill.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copy_to(folder, left_out):
    skip = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    shutil.copytree(os.path.join(ROOT, "tidemill"), folder / "tidemill", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), folder / name)


def run_in(folder, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=env, timeout=120)


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_imports_without_the_corpus_parts(tmp_path, left_out):
    catalog.load_all()
    copy_to(tmp_path, left_out)
    done = run_in(tmp_path, COUNT)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.CHECKS))]


def test_other_missing_modules_are_errors(tmp_path):
    copy_to(tmp_path, ["llm"])
    (tmp_path / "tidemill" / "llm").mkdir()
    (tmp_path / "tidemill" / "llm" / "__init__.py").write_text("")
    (tmp_path / "tidemill" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\n")
    done = run_in(tmp_path, COUNT)
    assert done.returncode != 0 and "a_module_that_is_not_there" in done.stderr
