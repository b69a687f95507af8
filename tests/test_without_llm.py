"""The rest of the library without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_queries_and_tests_load_without_the_package(tmp_path):
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__", ".git", "*.json")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    queries, twins, others = run.stdout.split()
    assert queries == twins and int(queries) >= 74 and others == "False"
    found = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=copy, capture_output=True, text=True,
    )
    assert found.returncode == 0, found.stdout


def test_nothing_else_imports_the_package():
    for file in (ROOT / "linefit").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "linefit.llm" not in file.read_text(), file
