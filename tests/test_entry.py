from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

TOP = Path(__file__).resolve().parents[1]


def test_entry_has_rows_and_a_stable_schema(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["event_id", "mass"] and df.count() > 0


def test_queries_and_oracles_belong_together():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    shutil.copytree(TOP / "pleiad", tmp_path / "pleiad", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(TOP / "__spark_entry__.py", tmp_path)
    (tmp_path / "pleiad" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion of the sources may leave
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dimuon_mass' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=120)


def test_nothing_else_imports_them():
    for f in (TOP / "pleiad").rglob("*.py"):
        if "llm" not in f.relative_to(TOP).parts:
            assert "llm" not in f.read_text()
