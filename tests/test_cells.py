"""K-means over the cells of a grid against the fits start by start."""

import numpy as np
import pytest

from larder.operators.mining import cluster


@pytest.fixture(scope="module")
def rows(spark):
    """Overlapping groups: starts differ in how many steps they take."""
    rng = np.random.default_rng(3)
    at = rng.normal(0, 2, (5, 3))
    x = at[rng.integers(0, 5, 6000)] + rng.normal(0, 1, (6000, 3))
    return spark.createDataFrame(x.tolist(), "a DOUBLE, b DOUBLE, c DOUBLE").repartition(5).localCheckpoint()


def jobs(spark, make):
    spark.sparkContext.setJobGroup(name := f"jobs-{np.random.default_rng().integers(1 << 60)}", "")
    made = make()
    return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_all_starts_share_a_pass(spark, rows):
    by_start = cluster.fit_all(rows, [3, 5], 6, 100, ["a", "b", "c"])
    by_cells, n = jobs(spark, lambda: cluster.fit_all(rows, [3, 5], 6, 100, ["a", "b", "c"], few=0))
    x = np.array(rows.collect())
    for k in (3, 5):
        got, wanted = by_cells[k], by_start[k]
        assert got.inertia <= 1.002 * wanted.inertia
        assert (np.diff(got.centers[:, 0]) <= 0).all()
        # the centers hold: one more step over all rows moves none
        gaps = ((x[:, None] - got.centers) ** 2).sum(2)
        labels = gaps.argmin(1)
        moved = np.array([x[labels == j].mean(0) for j in range(k)])
        assert ((moved - got.centers) ** 2).sum(1).max() <= 2 * cluster.SHIFT_TOLERANCE / k
        assert abs(gaps.min(1).sum() - got.inertia) <= 1e-3 * got.inertia
    # start by start these are twelve fits of a dozen jobs and more
    assert n <= 60, n


def test_tallies_are_those_of_all_rows(rows):
    x = np.array(rows.collect())
    models = [x[:2], x[2:5]]
    for centers, (counts, sums, cost) in zip(models, cluster._tally(cluster._blocks(rows, ["a", "b", "c"]), models)):
        gaps = ((x[:, None] - centers) ** 2).sum(2)
        labels = gaps.argmin(1)
        assert counts.tolist() == np.bincount(labels, minlength=len(centers)).tolist()
        assert np.allclose(sums, [x[labels == j].sum(0) for j in range(len(centers))])
        assert abs(cost - gaps.min(1).sum()) < 1e-6


def test_alike_rows_and_missing_values(spark):
    same = spark.range(500).selectExpr("CAST(1 AS DOUBLE) AS a", "CAST(id % 3 AS DOUBLE) AS b")
    model = cluster.fit_all(same, [3], 2, 20, ["a", "b"], few=0)[3]
    assert model.inertia == 0 and sorted(model.centers[:, 1].tolist()) == [0, 1, 2]
    for missing in ("CAST(NULL AS DOUBLE)", "double('NaN')"):
        with pytest.raises(Exception, match="null|NaN"):
            cluster.fit_all(same.selectExpr("a", f"IF(b = 2, {missing}, b) AS b"), [2], 2, 20, ["a", "b"], few=0)
