"""The registered queries survive the absence of the optional parts."""

import os
import subprocess
import sys

import pytest

from farebox.plans.registry import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys, warnings
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
warnings.simplefilter("ignore")
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()), "pipeline" in E.queries(), any(n.startswith("op1") for n in E.queries()))
"""


@pytest.mark.parametrize("absent, operators", [("ahocorasick", False), ("xxhash", False), ("farebox.llm", False),
                                               ("corpus_pipeline", True)])
def test_queries_without_an_optional_part(absent, operators):
    pytest.importorskip("farebox.llm.queries")
    out = subprocess.run([sys.executable, "-c", BLOCK.format(name=absent, root=ROOT)], capture_output=True, text=True, check=True)
    n, sqls, pipeline, ops = out.stdout.split()
    assert (pipeline, ops) == ("False", str(operators))
    assert int(n) >= len(REGISTRY) and int(sqls) >= len(REGISTRY)
    if not operators:
        assert int(n) == len(REGISTRY)
