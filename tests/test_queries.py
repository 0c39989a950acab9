"""Every registered query of the trace engine equals its SQL."""

import pytest
from conftest import DATA, TABLES, same_rows

from tracelake.plans import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    same_rows(registry.queries()[name](spark, DATA), SQL[name], {t: f"{DATA}/{t}.parquet" for t in TABLES})


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; e.oracle_sql(); print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and int(out.stdout) > 70
