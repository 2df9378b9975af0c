"""The registry: every query with SQL has a function, and the engine stands without the corpus operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_sql_names_are_queries():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_corpus_operators(tmp_path):
    for name in ("voltplane", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'plate_from_points' in q and not [n for n in q if n.startswith('op') or n == 'pipeline'], list(q); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_corpus_queries_go_where_one_of_their_libraries_is_missing():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'plate_from_points' in q and 'op1_line_dedup' not in q; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_flagship(spark):
    import pytest

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
