"""The library without its optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

from mailspark.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def registered(folder: Path) -> tuple[list[str], list[str]]:
    """Names of the queries and statements that a fresh interpreter finds in a folder."""
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    queries, statements = run.stdout.splitlines()
    return queries.split(), statements.split()


def copy_without(folder: Path, *absent: str) -> Path:
    copied = [p for p in ROOT.iterdir() if p.suffix == ".py" or p.name in ("mailspark", "oracle")]
    folder.mkdir()
    for path in copied:
        if path.name in absent:
            continue
        if path.is_dir():
            leave = shutil.ignore_patterns("__pycache__", *(a for a in absent if a == "llm"))
            shutil.copytree(path, folder / path.name, ignore=leave)
        else:
            shutil.copy(path, folder / path.name)
    return folder


def test_library_without_the_subpackage(tmp_path):
    for n, absent in enumerate((("llm",), ("llm", "corpus_pipeline.py"))):
        queries, statements = registered(copy_without(tmp_path / str(n), *absent))
        assert queries == sorted(QUERIES) and set(statements) <= set(QUERIES)


def test_library_without_the_pipeline(tmp_path):
    queries, _ = registered(copy_without(tmp_path / "n", "corpus_pipeline.py"))
    assert "pipeline" not in queries and set(QUERIES) <= set(queries)
