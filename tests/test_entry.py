"""The entry without the text operators, and with a library missing that they need."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def _names(folder, before=""):
    code = f"{before}\nimport __spark_entry__ as e\nassert set(e.oracle_sql()) <= set(e.queries())\nprint(*sorted(e.queries()))"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)


def test_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT / "sensorloom", tmp_path / "sensorloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    done = _names(tmp_path)
    assert done.returncode == 0, done.stderr
    assert "hourly_rollup" in done.stdout and "op1_" not in done.stdout


def test_a_missing_library_is_not_swallowed(tmp_path):
    if not (ROOT / "sensorloom" / "llm").exists():
        return
    done = _names(ROOT, "import sys; sys.modules['numpy'] = None")
    assert done.returncode != 0 and "numpy" in done.stderr
