import numpy as np
from pyspark.sql import functions as F

from quakespark.functions import timefn


def test_seconds_print_as_python_prints_them(spark):
    """The reference prints the second as %06.3f of the binary value; ties of the decimal digits are no ties of that."""
    rng = np.random.default_rng(8)
    ties = [(2 * k + 1) / 2000 for k in rng.integers(0, 30_000, 2000).tolist()]  # 35.1185 and its like
    exact = [k / 16 for k in range(960)]  # 0.0625 lies exactly half way
    near = [x for t in ties[:300] for x in (float(np.nextafter(t, 0)), float(np.nextafter(t, 60)))]
    values = [35.1185, 0.0, 0.0005, 0.0015, 59.9995, 59.9994999, 59.99951, *ties, *exact, *near, *rng.uniform(0, 60, 500).tolist()]
    rows = spark.createDataFrame([(v,) for v in values], "sc double")
    one = F.lit(1)
    got = rows.select("sc", timefn.parts_to_iso(F.lit(2012), one, one, one, one, "sc").alias("text")).collect()
    assert [r.text for r in got] == [f"2012-01-01T01:01:{r.sc:06.3f}Z" for r in got]


def test_null_second_gives_no_number(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS sc").select(timefn.rounded_millis("sc").alias("ms")).first()
    assert row.ms is None
