import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_training_data_part(tmp_path):
    for name in ("tidewire", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "tidewire" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; n = e.queries(); assert n and not any(k.startswith('op') or k == 'pipeline' for k in n); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
