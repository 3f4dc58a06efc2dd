"""The entry module with and without the subpackage."""

import os
import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), sum(n.startswith("op") for n in q), "pipeline" in q, set(o) <= set(q))
"""


def listed(*blocked):
    said = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, check=True)
    return said.stdout.split()


def test_entry_lists_all_queries():
    there = os.path.exists(os.path.join(ROOT, "tessera", "llm", "queries.py")) and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py"))
    assert listed()[1:] == (["10", "True", "True"] if there else ["0", "False", "True"])


def test_entry_without_the_subpackage():
    without = listed("tessera.llm")
    assert without[1:] == ["0", "False", "True"] and int(without[0]) > 70
    assert without == listed("public_tokenizers") == listed("corpus_pipeline")
