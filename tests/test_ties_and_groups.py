"""k-NN on ties and small groups, decisions of NaN, and the search's ranges."""


import pytest
from pyspark.sql import functions as F

from attrition.operators.knn import knn
from attrition.operators.segments import hard_decision


def neighbours(df):
    return {(r["id"], r["rank"]): r["neighbor_id"] for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 4])
def test_identical_points_take_the_smallest_ids(spark, parts):
    pts = spark.createDataFrame([(i, [1.1, 2.2, 3.3]) for i in range(60)], "id long, vec array<double>")
    got = neighbours(knn(pts.repartition(parts), "id", "vec", k=5))
    for i in range(60):
        want = [j for j in range(60) if j != i][:5]
        assert [got[i, r] for r in range(1, 6)] == want


def test_many_small_groups_and_a_null_group(spark):
    rows = [(g * 20 + i, str(g) if g < 40 else None, [float(i), float(g)]) for g in range(41) for i in range(20)]
    pts = spark.createDataFrame(rows, "id long, grp string, vec array<double>")
    got = knn(pts, "id", "vec", k=3, group_col="grp")
    assert got.count() == 40 * 20 * 3
    assert got.filter(F.col("id") >= 800).count() == 0


def test_nan_is_no_decision(spark):
    df = spark.createDataFrame([(0.5,), (0.2,), (float("nan"),), (None,)], "p double")
    assert [r[0] for r in df.select(hard_decision("p")).collect()] == [1, 0, None, None]
