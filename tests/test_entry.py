"""The driver's contract without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_entry_without_the_optional_folders(tmp_path):
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 40 and set(o) <= set(q); print(len(q))"
    for pipeline in (True, False):
        if not pipeline:
            (tmp_path / "repo/corpus_pipeline.py").unlink(missing_ok=True)
        run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
        assert run.returncode == 0, run.stderr


def test_names_of_queries_and_sql_agree():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
