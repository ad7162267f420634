"""The library imports and answers without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_imports_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
