"""The entry points without the operators for training data, or without a package that they need."""

import os
import subprocess
import sys

import pytest

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {0!r} or name.startswith({0!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), sum(n.startswith("op") and n[2].isdigit() for n in e.queries()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "public_tokenizers", "xxhash", "orelayer.llm", "corpus_pipeline"])
def test_other_queries_stay(name):
    out = subprocess.run([sys.executable, "-c", HIDE.format(name)], cwd=HOME, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-800:]
    queries, sqls, dealt = map(int, out.stdout.split())
    assert queries >= 110 and sqls >= 110 and dealt == 0
