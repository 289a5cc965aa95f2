"""The driver entry with and without what the training-data operators need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), sum(q.startswith("op") and q[2].isdigit() for q in entry.queries()), "pipeline" in entry.queries(), set(entry.oracle_sql()) <= set(entry.queries()))
"""


def told(name):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    return done.stdout.split() if not done.returncode else done.stderr


def test_queries_without_the_subpackage_or_its_libraries():
    plain = told("shelfline.llm")
    assert plain[1:] == ["0", "False", "True"] and int(plain[0]) > 100
    assert told("regex") == plain


def test_errors_of_the_subpackage_show():
    if not (ROOT / "shelfline" / "llm").exists():
        pytest.skip("no subpackage")
    assert "cannot import name 'chunks'" in told("shelfline.llm.chunks")
