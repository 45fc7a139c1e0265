"""The entry module works on a checkout without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), sorted(set(s) - set(q)))"


def checkout(tmp_dir, *without):
    to = os.path.join(tmp_dir, "checkout")
    shutil.copytree(ROOT, to, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", "tests")
                                                       or os.path.relpath(os.path.join(d, n), ROOT) in without])
    return to


def run(cwd, code):
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("without", [("barsmith/llm",), ("barsmith/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_queries_without_the_subpackage(tmp_dir, without):
    from barsmith import catalog

    done = run(checkout(tmp_dir, *without), COUNT)
    assert done.returncode == 0, done.stderr
    n_queries, n_sql, unknown = done.stdout.split(maxsplit=2)
    assert int(n_queries) >= len(catalog.queries()) and int(n_sql) >= len(catalog.queries()) and unknown.strip() == "[]"
    if "barsmith/llm" in without:
        assert int(n_queries) == len(catalog.queries())


def test_other_import_errors_are_raised(tmp_dir):
    """A module that exists but needs something else that is missing is an error, not an absence."""
    where = checkout(tmp_dir)
    with open(os.path.join(where, "corpus_pipeline.py"), "w") as f:
        f.write("import barsmith.no_such_module\n")
    done = run(where, COUNT)
    assert done.returncode != 0 and "barsmith.no_such_module" in done.stderr
