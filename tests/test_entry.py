"""The driver's entry points without the subpackage of the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

# A module that cannot be imported: of the subpackage, of what it needs, the pipeline.
WITHOUT = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
queries, sql = entry.queries(), entry.oracle_sql()
assert "c12_clean_transactions" in queries and "c12_clean_transactions" in sql
assert not any(k.startswith("op") or k == "pipeline" for k in [*queries, *sql])
"""


def test_other_queries_do_without_it():
    for name in ("ledgerlens.llm", "zstandard", "corpus_pipeline"):
        run = subprocess.run([sys.executable, "-W", "ignore", "-c", WITHOUT.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=False)
        assert run.returncode == 0, run.stderr
