"""The entry module with and without the parts that may be absent."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
from tidemark.workload.queries import QUERIES
assert set(entry.queries()) == set(QUERIES), set(entry.queries()) ^ set(QUERIES)
assert set(entry.oracle_sql()) == set(QUERIES)
"""


def run(hidden):
    code = HIDE.format(hidden=hidden)
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_queries_without_the_optional_parts():
    done = run(["corpus_pipeline", "tidemark.llm", "tidemark.llm.queries"])
    assert done.returncode == 0, done.stderr


def test_other_import_errors_are_not_swallowed():
    assert run(["tidemark.workload.queries"]).returncode != 0
