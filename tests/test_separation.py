"""The library works without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = """
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert len(q) >= 58 and set(o) <= set(q), sorted(q)
assert not [n for n in q if n.startswith("op")] and "pipeline" not in q
import bench, grimlake.plans.jobs, grimlake.__main__
"""


@pytest.mark.parametrize("left_out", [("grimlake/llm", "tests/llm"), ("grimlake/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_subpackage(tmp_path, left_out):
    names = [*left_out, ".git", "__pycache__"]
    skip = lambda folder, files: [f for f in files if os.path.relpath(os.path.join(folder, f), ROOT) in names]
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skip)
    assert not (copy / "grimlake/llm").exists()
    done = subprocess.run([sys.executable, "-B", "-c", CODE], cwd=copy, capture_output=True, text=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr
