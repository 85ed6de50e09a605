"""The entry module with and without the optional sub-package."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names():
    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries)
    assert {"intersections", "way_sections", "merged_segments", "tile_records"} <= set(queries)


def test_without_the_optional_parts(tmp_path):
    for name in ("waymesh", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(source) else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'intersections' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q), list(q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=120)
