"""The entry works with and without the optional operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
LISTED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(before: str = "") -> list[set[str]]:
    done = subprocess.run([sys.executable, "-c", f"import sys; {before}{LISTED}"], cwd=REPO, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in done.stdout.splitlines()]


def test_entry_without_the_optional_operators():
    queries, statements = names("sys.modules['isobar.llm'] = sys.modules['corpus_pipeline'] = None; ")
    assert "daily_global" in queries and statements == queries
    assert not any(name.startswith("op") for name in queries) and "pipeline" not in queries


def test_every_statement_belongs_to_a_query():
    queries, statements = names()
    assert statements <= queries
