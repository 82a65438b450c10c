"""The demand forest holds the statistics of few nodes at once, and grows the same trees."""

import numpy as np
from pyspark.ml.regression import RandomForestRegressor

from larder.operators.mining import features, regress


def test_few_nodes_at_once_grow_the_same_trees(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 200, (3000, 3)).astype(float)
    data = [(*map(float, row), float(row[0] + 3 * row[1] + rng.normal(0, 40))) for row in x]
    train = features.assemble(spark.createDataFrame(data, "a DOUBLE, b DOUBLE, c DOUBLE, sold_qty DOUBLE"),
                              ["a", "b", "c"]).coalesce(3).localCheckpoint()
    model = regress.fit_forest(train, trees=8, depth=9)
    wide = RandomForestRegressor(
        labelCol="sold_qty", numTrees=8, maxDepth=9, featureSubsetStrategy="all", maxBins=features.MAX_BINS,
        maxMemoryInMB=1024, cacheNodeIds=True, seed=regress.SEED).fit(train)
    trees = [[tree.toDebugString.split("\n", 1)[1] for tree in m.trees] for m in (model, wide)]
    assert trees[0] == trees[1] and model.totalNumNodes > 1000
    # two tasks of an executor with 1,800 MB of heap hold these statistics, their copies and the rows
    assert model.getMaxMemoryInMB() <= 128 and not model.getCacheNodeIds()
