"""The driver entry works with and without the training-data package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
sys.path.insert(0, {root!r})
sys.modules["starbeam.llm"] = None
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
names = set(e.queries())
assert "rp1_report_customers" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(e.oracle_sql()) == names
"""


def test_entry_without_the_training_data_package():
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(root=ROOT)], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert done.returncode == 0, done.stderr


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
