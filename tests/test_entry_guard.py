"""The entry module works where the training-data subpackage and the pipeline are absent."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "strataloom", tmp_path / "strataloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(ROOT / "jobs", tmp_path / "jobs", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}, timeout=120)


def test_nothing_else_imports_llm():
    for folder in ("strataloom", "jobs"):
        for f in (ROOT / folder).rglob("*.py"):
            if "llm" not in f.relative_to(ROOT / folder).parts:
                assert "strataloom.llm" not in f.read_text() and "corpus_pipeline" not in f.read_text(), f
