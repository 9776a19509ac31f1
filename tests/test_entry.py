"""The entry module with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

_CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as E
assert E.__file__.startswith({root!r})
names = sorted(E.queries())
assert sorted(set(E.oracle_sql()) - set(names)) == []
print(len(names), sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names))
"""


def _counts(root):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", _CODE.format(root=str(root))], cwd=root, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return tuple(map(int, out.stdout.split()))


def _copy(dst, *without):
    shutil.copytree(ROOT, dst, ignore=lambda d, names: {".git", "__pycache__", ".pytest_cache"}
                    | {n for n in names if os.path.relpath(os.path.join(d, n), ROOT) in without})
    return dst


def test_queries_survive_the_subpackage_and_pipeline_deleted(tmp_path):
    folders = (os.path.join("eventfeat", "llm"), os.path.join("tests", "llm"))
    core, dealt = _counts(_copy(tmp_path / "both", *folders))  # the pipeline file is still there
    assert dealt == 0 and core > 90
    assert _counts(_copy(tmp_path / "all", *folders, "corpus_pipeline.py")) == (core, 0)


def test_an_emptied_folder_counts_as_deleted(tmp_path):
    root = _copy(tmp_path / "empty", os.path.join("eventfeat", "llm"))
    os.makedirs(root / "eventfeat" / "llm" / "__pycache__")
    assert _counts(root)[1] == 0
