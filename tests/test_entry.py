"""The driver contract, with and without the optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 1


def test_every_sql_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_parts(tmp_path):
    shutil.copytree(ROOT / "dirlens", tmp_path / "dirlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 40, len(q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "dirlens").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "dirlens").parts:
            assert "dirlens.llm" not in path.read_text()
