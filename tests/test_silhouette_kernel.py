"""The Euclidean silhouette makes no array of a batch's distances to all partners."""

import tracemalloc

import numpy as np

from larder.operators.mining import cluster


def test_distances_stay_small(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3000, 3)) + 4 * rng.integers(0, 2, (3000, 1))
    data = [(i, int(row[0] > 2), *map(float, row)) for i, row in enumerate(x)]
    df = spark.createDataFrame(data, "fact_id BIGINT, cluster INT, a DOUBLE, b DOUBLE, c DOUBLE")
    labels = np.array([row[1] for row in data])
    distance = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    sums = np.stack([distance[:, labels == c].sum(1) for c in (0, 1)], 1)
    n = np.bincount(labels)
    inner = sums[np.arange(3000), labels] / (n[labels] - 1)
    outer = sums[np.arange(3000), 1 - labels] / n[1 - labels]
    wanted = ((outer - inner) / np.maximum(inner, outer)).mean()

    seen = {}

    def here(frame, score, schema):
        pdf = frame.toPandas()
        tracemalloc.start()
        out = next(iter(score([pdf])))
        seen["mb"] = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        return spark.createDataFrame(out, schema)

    monkeypatch.setattr(type(df), "mapInPandas", here)
    got = cluster.euclidean_silhouette(df, ["a", "b", "c"], partners=2000).first()
    assert got["exact"] and abs(got["silhouette"] - wanted) < 1e-6
    # about 1,500 partners of a cluster: 12 KB for each row, of which few are in memory together
    assert seen["mb"] < 6, seen
