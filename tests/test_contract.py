"""Driver contract: the registry loads without a Spark session."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_loads_without_a_session():
    code = ("import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); "
            "assert set(o) <= set(q); assert len(q) >= 100 and len(o) >= 90; "
            "from pyspark.sql import SparkSession; "
            "assert SparkSession.getActiveSession() is None; print(len(q), len(o))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]


def test_oracles_use_only_driver_views():
    import __spark_entry__ as e
    for name, sql in e.oracle_sql().items():
        assert "read_parquet" not in sql and "/root/" not in sql, name
