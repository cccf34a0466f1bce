"""The registry, and the library without its training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_imports_without_session_or_llm():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('paperlane.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()), list(e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_llm():
    for path in (ROOT / "paperlane").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm import" not in path.read_text() and "import llm" not in path.read_text(), path


def test_flagship(spark):
    import __spark_entry__ as e
    from paperlane.plans.schema import INVENTORY

    assert e.entry(spark).columns == INVENTORY
