"""The entry without the training-data operators, or without what only they need."""

import subprocess
import sys

import pytest

BLOCKED = """
import importlib.abc, sys
class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
names = set(entry.queries())
print(len(names), sum(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names, set(entry.oracle_sql()) <= names)
"""


@pytest.mark.parametrize("name", ["riskframe.llm", "zstandard", "regex", "corpus_pipeline"])
def test_the_rest_stays(name):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], capture_output=True, text=True, check=True)
    n, ops, pipeline, known = done.stdout.split()
    assert int(n) - int(ops) >= 128 and known == "True"
    assert "left out" in done.stderr
    if name == "corpus_pipeline":
        assert pipeline == "False"
    else:  # a pipeline that does not need what is missing stays
        assert ops == "0" and (pipeline == "False" or name != "riskframe.llm")
