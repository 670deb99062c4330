"""The entry module, whole and without the folders that may be absent."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder: Path) -> set[str]:
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(*e.queries())"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return set(run.stdout.split())


def test_entry_works_without_the_training_data_subpackage(tmp_path):
    shutil.copytree(ROOT / "layerloom", tmp_path / "layerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    without = names(tmp_path)
    assert "financial_analytics" in without and not {n for n in without if n.startswith("op") or n == "pipeline"}
    assert without <= names(ROOT)
