"""The entry module with and without its optional parts."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()), sep='\\n')"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_optional_subpackage(tmp_path, pipeline):
    """A copy without the subpackage, with or without the pipeline's file, registers every other query."""
    from hearth.registry import ORACLE, QUERIES

    for name in ("hearth", "__spark_entry__.py") + (("corpus_pipeline.py",) if pipeline else ()):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(src):
            shutil.copy(src, tmp_path / name)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": ""}, check=True).stdout.splitlines()
    assert out == [str(sorted(QUERIES)), str(sorted(ORACLE))]


def test_entry_with_everything_present():
    """With the subpackage there, its queries are added; its own import errors are not hidden."""
    import __spark_entry__ as entry

    from hearth.registry import QUERIES

    assert set(QUERIES) <= set(entry.queries())
    if os.path.exists(os.path.join(ROOT, "hearth", "llm", "queries.py")):
        assert "op3_url_verdicts" in entry.queries()
