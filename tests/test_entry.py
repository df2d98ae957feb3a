import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_needs_no_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q); import pyspark; assert pyspark.SparkContext._active_spark_context is None"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4
