"""The entry without what only the add-on needs."""

import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {0!r} or name == {0!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
assert len(e.queries()) >= 48 and not any(q.startswith("op") or q == "pipeline" for q in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("module", ["public_tokenizers", "corpus_pipeline", "ledgerlens.llm"])
def test_other_queries_stay_without(module):
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", CODE.format(module)], cwd=root, check=True, capture_output=True)
