import pytest
from pyspark.sql import functions as F

from merch.functions import numbers as num
from merch.operators import moq

CASES = [
    ([0, 0, 0, 0, 0, 20], "x", 2, [0, 0, 0, 0, 0, 20]),
    ([0, 0, 3, 4, 5, 6], "x", 2, [0, 0, 0, 0, 16, 0]),
    ([0, 0, 2, 2, 2, 2], "x", 2, [0, 0, 0, 0, 16, 0]),
    ([0, 0, 2, 2, 2, 2], "x", 1, [0, 0, 0, 0, 8, 0]),
    ([9, 9, 9, 9, 9, 9], "x", 1, [16, 0, 16, 0, 0, 16]),
    ([5, 5, 5, 5, 5, 0], "x", 2, [5, 5, 5, 5, 5, 0]),
    ([5, 5, 5, 5, 5, 0], "x", 1, [5, 5, 5, 5, 5, 0]),
    ([0, 0, 0, 0, 90, 7], "Wheel Hub", 2, [0, 0, 0, 0, 12, 12]),
    ([0, 0, 0, 0, 0, 29], "Brake Pads", 2, [0, 0, 0, 0, 0, 30]),
    ([1, 1, 1, 1, 1, 49], "ABS Sensor", 2, [0, 0, 0, 0, 50, 0]),
    ([9, 9, 9, 9, 9, 50], "ABS Sensor", 2, [9, 9, 9, 9, 9, 50]),
]


@pytest.mark.parametrize("version", [1, 2])
def test_traced_cases(spark, version):
    cases = [(i, *c) for i, c in enumerate(CASES) if c[2] == version]
    df = spark.createDataFrame([(i, kind, *v) for i, v, kind, _, _ in cases], "i int, type string, " + ", ".join(f"{c} int" for c in moq.SLOTS))
    got = {r["i"]: [r[c] for c in moq.SLOTS] for r in moq.moq_consolidate(df, version=version).collect()}
    assert got == {i: want for i, _, _, _, want in cases}


def test_lost_quantity_and_even_lots(spark):
    df = spark.createDataFrame([("Wheel Hub", 0, 0, 0, 0, 90, 7), ("x", 1, 2, 3, 4, 5, 17)], "type string, " + ", ".join(f"{c} int" for c in moq.SLOTS))
    rows = moq.moq_even_lots(moq.moq_consolidate(df)).collect()
    assert rows[0]["lost_qty"] == 6 * 12
    assert [rows[1][c] for c in moq.SLOTS] == [0, 2, 2, 4, 4, 16]


def test_list_helpers(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0],), ([0.0, 1.0, 2.0, 0.0, 3.0],), ([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    rows = df.select(num.list_sum(F.col("v")).alias("s"), num.non_zero_mean(F.col("v")).alias("m"), num.non_zero_positions(F.col("v")).alias("p")).collect()
    assert [(r["s"], r["m"], r["p"]) for r in rows] == [(0.0, 0.0, []), (6.0, 2.0, [1, 2, 4]), (10.0, 2.5, [0, 1, 2, 3])]
