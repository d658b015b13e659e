"""The driver's contract, with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry_has_rows(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["census_state", "occ_count", "species_count"] and found.count() > 0


def test_sql_has_a_query_for_each():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_training_data_operators(tmp_path):
    for name in ("__spark_entry__.py", "wildgrid"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        copy(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "wildgrid/llm", ignore_errors=True)
    code = "import re, __spark_entry__ as e; q = e.queries(); assert 'counts_by_state' in q and not any(re.match('op[0-9]|pipeline', n) for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
