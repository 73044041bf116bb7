import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["label", "stage", "ord", "n"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_core_stands_alone(tmp_path):
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q and not any(n.startswith('op1_') for n in q); print('fine')"
    out = subprocess.run([sys.executable, "-c", code], cwd=target, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "fine", out.stderr


def test_nothing_else_imports_the_operators():
    for path in ROOT.glob("sievekit/**/*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm import" not in path.read_text() and "from .llm" not in path.read_text()
