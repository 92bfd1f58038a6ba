"""The contract holds with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"


def test_without_optional_parts(tmp_path):
    for name in ("pisteflow", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path)
    said = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    total, optional, known = said.stdout.split() or ("0", "0", "")
    assert int(total) >= 40 and optional == "0" and known == "True", said.stderr


def test_nothing_else_imports_it():
    for path in (ROOT / "pisteflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "pisteflow.llm" not in path.read_text()


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
