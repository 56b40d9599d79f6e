import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules[{name!r}] = None  # importing it fails
sys.path.insert(0, {root!r})
import __spark_entry__ as e
q, sql = e.queries(), e.oracle_sql()
assert len(q) >= 52 and not any(n.startswith("op") or n == "pipeline" for n in q), sorted(q)
assert "daily_cost" in q and set(sql) <= set(q)
"""


@pytest.mark.parametrize("name", ["xxhash", "public_tokenizers", "gridlake.llm"])
def test_other_queries_stay_when_a_package_of_the_subpackage_is_absent(name):
    out = subprocess.run([sys.executable, "-c", CODE.format(name=name, root=ROOT)], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
