"""Euclidean silhouette of all rows against its definition."""

import numpy as np
import pytest

from larder.operators.mining import cluster


def planted(spark, sizes):
    """Rows around a center for each cluster, and their silhouettes by the definition."""
    drawn = np.random.default_rng(5)
    x = np.concatenate([drawn.normal(3 * c, 1 + c / 2, (n, 2)) for c, n in enumerate(sizes)])
    own = np.repeat(np.arange(len(sizes)), sizes)
    df = spark.createDataFrame([(i, int(c), float(a), float(b)) for i, (c, (a, b)) in enumerate(zip(own, x))],
                               "fact_id BIGINT, cluster INT, a DOUBLE, b DOUBLE")
    values = []
    for i, c in enumerate(own):
        distance = np.sqrt(((x - x[i]) ** 2).sum(1))
        others = [distance[own == d].mean() for d in range(len(sizes)) if d != c and sizes[d]]
        if sizes[c] == 1 or not others:
            values.append(0.0)
            continue
        inner, outer = distance[own == c].sum() / (sizes[c] - 1), min(others)
        values.append((outer - inner) / max(inner, outer))
    return df, float(np.mean(values))


@pytest.mark.parametrize("sizes", [[40, 60, 1], [30], [1, 1]])
def test_whole_clusters_are_exact(spark, sizes):
    df, value = planted(spark, sizes)
    got = cluster.euclidean_silhouette(df, ["a", "b"]).first()
    assert abs(got["silhouette"] - value) < 1e-6
    assert (got["error_bound"], got["records"], got["exact"]) == (0, sum(sizes), True)


def test_partners_stay_within_the_bound(spark):
    df, value = planted(spark, [1500, 700, 90])
    bounds = []
    for partners in (100, 400):
        got = cluster.euclidean_silhouette(df, ["a", "b"], partners=partners).first()
        assert abs(got["silhouette"] - value) <= got["error_bound"] and not got["exact"]
        again = cluster.euclidean_silhouette(df.repartition(3), ["a", "b"], partners=partners).first()
        assert abs(again["silhouette"] - got["silhouette"]) < 1e-9 and got["records"] == 2290
        bounds.append(got["error_bound"])
    assert bounds[1] < bounds[0] < 0.3


def test_repeated_points_and_no_rows(spark):
    df = spark.createDataFrame([(i, i % 2, 1.0) for i in range(6)], "fact_id BIGINT, cluster INT, a DOUBLE")
    assert cluster.euclidean_silhouette(df, ["a"]).first()["silhouette"] == 0
    got = cluster.euclidean_silhouette(df.limit(0), ["a"]).first()
    assert (got["silhouette"], got["records"]) == (None, 0)
