import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_imports_without_llm_and_pipeline(tmp_path):
    """A copy of the repository without the llm folder and the pipeline still registers its own queries."""
    import shutil

    shutil.copytree(ROOT / "tallyweave", tmp_path / "tallyweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 50 and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_names_llm():
    for p in (ROOT / "tallyweave").rglob("*.py"):
        if "llm" not in p.parts:
            assert "tallyweave.llm" not in p.read_text()
