"""K-means archetypes: standardizing, fitting, quality indices, profiles."""

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import exact, fixed, keyhash
from larder.operators.mining import features
from larder.sources.warehouse import Star

COLUMNS = ["sold_qty", "waste_qty", "waste_percentage", "checkout_price", "discount_percent"]
SCALED = [f"z_{c}" for c in COLUMNS]
K, STARTS, ITERATIONS, SEED = 4, 10, 300, 42
ELBOW_KS, ELBOW_STARTS, ELBOW_ITERATIONS = [2, 3, 4, 5, 6], 5, 150
SHIFT_TOLERANCE = 1e-4  # summed squared center shift at which a start has converged
PARTNERS = 1_000        # rows, about, that stand for a larger cluster in distances to it
DEVIATIONS = 3          # standard errors in the bound of an estimate
BLOCK = 64              # rows whose distances to the partners of a cluster are in the processor's cache together
AT_ONCE = 5             # fits whose jobs are submitted together
PART_ROWS = 250_000     # rows of a task at least: a fit is many short rounds
CELLS = 250_000         # cells of the grid that rows are summed by, at most
BLOCKS_AT_ONCE = 16     # blocks whose cells are summed together
LEAST_CELLS = 10        # cells for each center at least, if starts are to run on them


def extract(star: Star, cap: int | None = None) -> DataFrame:
    rows = star.join("item").select(
        "fact_id", *[F.col(c).cast("double").alias(c) for c in COLUMNS],
        "item_name", "category", "cuisine")
    return rows if cap is None else features.hash_sample(rows, "fact_id", cap)


def standardize(df: DataFrame, columns: Sequence[str] = COLUMNS, values: DataFrame | None = None) -> DataFrame:
    """Add z_ columns: centered, divided by the population deviation (or 1 if that is 0).

    The two moments of each column are one row, joined as scalars. `values` has the same values, if they
    are to be had for less.
    """
    moments = (df if values is None else values).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return df.withColumns({
        f"z_{c}": (F.col(c) - F.lit(moments[f"mean_{c}"])) / F.lit(moments[f"std_{c}"] or 1.0)
        for c in columns
    })


@dataclass(frozen=True)
class Clusters:
    """Fitted centers, ordered by mean sold quantity (largest first), and their inertia."""

    centers: np.ndarray
    inertia: float
    iterations: int


def fit_all(scaled: DataFrame, ks: Sequence[int], starts: int = STARTS,
            iterations: int = ITERATIONS, columns: Sequence[str] = SCALED, few: int = PART_ROWS) -> dict[int, Clusters]:
    """K-means for each k, the best of several starts by inertia.

    Up to `few` rows are fitted start by start (fit_starts). More rows are first summed by cells of a grid,
    on which the starts are seeded and run; they end over the rows themselves (fit_cells).
    """
    n = scaled.count()
    if n <= few:
        return fit_starts(scaled, ks, starts, iterations, columns, n)
    blocks = _blocks(scaled, list(columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cells = _cells(blocks, len(columns))
        if len(cells) >= LEAST_CELLS * max(ks):
            return fit_cells(blocks, cells, ks, starts, iterations)
    finally:
        blocks.unpersist()
    return fit_starts(scaled, ks, starts, iterations, columns, n)  # values too alike for a grid


def fit_starts(scaled: DataFrame, ks: Sequence[int], starts: int, iterations: int, columns: Sequence[str],
               n: int) -> dict[int, Clusters]:
    """K-means for each k over n rows, the best of several starts by inertia.

    A start is a fit with a seed of its own, which seeds by k-means|| over all rows. Fits are
    submitted AT_ONCE together, so the short jobs of one fill the gaps of another; they share the
    persisted vectors, which are read again from `scaled` where an executor is lost.
    """
    vectors = features.assemble(scaled, list(columns)).select("features").coalesce(
        max(1, n // PART_ROWS)).persist(StorageLevel.MEMORY_AND_DISK)

    def fitted(run: tuple[int, int]) -> Clusters:
        k, start = run
        model = KMeans(k=k, seed=SEED + start, maxIter=iterations, tol=(SHIFT_TOLERANCE / k) ** 0.5).fit(vectors)
        centers = np.array(model.clusterCenters())
        return Clusters(centers[np.argsort(-centers[:, 0], kind="stable")], model.summary.trainingCost, model.summary.numIter)

    runs = [(k, start) for k in ks for start in range(starts)]
    try:
        vectors.count()
        with ThreadPoolExecutor(AT_ONCE) as pool:
            models = list(pool.map(inheritable_thread_target(scaled.sparkSession)(fitted), runs))
    finally:
        vectors.unpersist()
    return _best((k, model) for (k, _), model in zip(runs, models))


def _best(models: Iterable[tuple[int, Clusters]]) -> dict[int, Clusters]:
    best: dict[int, Clusters] = {}
    for k, model in models:
        if k not in best or model.inertia < best[k].inertia:
            best[k] = model
    return best


def _blocks(scaled: DataFrame, columns: list[str]) -> RDD:
    """All rows as blocks, a matrix of the columns for each Arrow batch.

    A pass over persisted blocks costs little besides its sums: rows are taken apart and sent to Python once.
    """
    def block(batches):
        for batch in batches:
            if any(column.null_count for column in batch.columns):
                raise ValueError(f"null in {columns}")
            x = np.stack([column.to_numpy() for column in batch.columns])
            if np.isnan(x).any():
                raise ValueError(f"NaN in {columns}")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()])], ["matrix"])

    width = len(columns)
    rows = scaled.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(block, "matrix BINARY")
    return rows.rdd.map(lambda row: np.frombuffer(row["matrix"]).reshape(width, -1))


def _cells(blocks: RDD, width: int) -> np.ndarray:
    """Count and column sums of all rows by cell of a grid: at most CELLS cells, whatever the number of rows.

    The cuts are the means of the blocks' quantiles. Any cuts are right; these keep the cells of like size.
    """
    cut = min(width, int(np.log2(CELLS)))  # columns that are cut
    parts = int(CELLS ** (1 / cut))
    size = parts ** cut

    def quantiles(x):
        n = x.shape[1]
        return (n, n * np.quantile(x[:cut], np.arange(1, parts) / parts, axis=1).T) if n else (0, np.zeros((cut, parts - 1)))

    n, weighted = blocks.map(quantiles).reduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    cuts = np.sort(weighted / n)

    def tally(matrices):
        totals = np.zeros((width + 1, size))
        for some in batched(matrices, BLOCKS_AT_ONCE):
            x = np.concatenate(some, 1)
            cell = sum(np.searchsorted(cuts[i], x[i]) * parts ** i for i in range(cut))
            totals[0] += np.bincount(cell, minlength=size)
            for total, values in zip(totals[1:], x):
                total += np.bincount(cell, values, size)
        taken = np.flatnonzero(totals[0])
        yield from zip(taken.tolist(), totals[:, taken].T)

    # a task sends a row for each of its cells, and the driver gets one for each cell
    sums = blocks.mapPartitions(tally).reduceByKey(lambda a, b: a + b).collect()
    return np.array([row for _, row in sorted(sums, key=lambda cell: cell[0])])


def fit_cells(blocks: RDD, cells: np.ndarray, ks: Sequence[int], starts: int,
              iterations: int) -> dict[int, Clusters]:
    """K-means for each k, the best of several starts by inertia, all starts in the same passes over all rows.

    Each start is seeded by k-means++ from the means of the cells, weighted by their rows, and run on them
    until no cell changes its center; that takes no pass. Starts that came to the same centers go on as one.
    From there, all of them go on over the rows until their centers hold: a pass reads the rows once.
    """
    weights, points = cells[:, 0], cells[:, 1:] / cells[:, :1]
    active = {}
    for k in ks:
        for start in range(starts):
            centers = _run_on_cells(points, weights, k, np.random.default_rng([SEED, start]), iterations)
            active[(k, *np.round(centers, 9).ravel())] = k, centers
    ended, active = [], list(active.values())
    for passes in range(1, iterations + 1):
        tallies = _tally(blocks, [centers for _, centers in active])
        going = []
        for (k, centers), (counts, sums, cost) in zip(active, tallies):
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
            if passes < iterations and ((moved - centers) ** 2).sum(1).max() > SHIFT_TOLERANCE / k:
                going.append((k, moved))
            else:
                ended.append((k, Clusters(moved[np.argsort(-moved[:, 0], kind="stable")], cost, passes)))
        active = going
        if not active:
            break
    return _best(ended)


def _run_on_cells(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator,
                  iterations: int) -> np.ndarray:
    """k-means++ and the steps of k-means on weighted points; centers by their first column."""
    chosen = [random.choice(len(points), p=weights / weights.sum())]
    gap = np.full(len(points), np.inf)
    for _ in range(k - 1):
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
        chosen.append(random.choice(len(points), p=weights * gap / (weights * gap).sum()))
    centers, labels = points[chosen], None
    for _ in range(iterations):
        before, labels = labels, ((centers ** 2).sum(1) - 2 * points @ centers.T).argmin(1)
        if before is not None and (labels == before).all():
            break
        counts = np.bincount(labels, weights, k)
        sums = np.stack([np.bincount(labels, weights * x, k) for x in points.T], 1)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers[np.argsort(-centers[:, 0], kind="stable")]


def _tally(blocks: RDD, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each set of centers: the rows nearest to each center, their column sums, and the inertia; in one pass."""
    width = models[0].shape[1]
    at = [np.hstack([-2 * c, (c ** 2).sum(1)[:, None]]) for c in models]

    def tally(matrices):
        totals = [np.zeros((len(c), width + 3)) for c in models]
        for matrix in matrices:
            x = np.vstack([matrix, np.ones(matrix.shape[1]), (matrix ** 2).sum(0), np.empty(matrix.shape[1])])
            for total, centers in zip(totals, at):
                gaps = centers @ x[:-2]
                x[-1] = least = np.minimum.reduce(gaps)
                left = np.full(least.shape, True)
                for j, gap in enumerate(gaps):
                    own = (gap == least) & left
                    left &= ~own
                    total[j] += x @ own
        yield totals

    totals = blocks.mapPartitions(tally).reduce(lambda a, b: [x + y for x, y in zip(a, b)])
    return [(t[:, width], t[:, :width], max(0.0, float(t[:, -2:].sum()))) for t in totals]


def fit(scaled: DataFrame, k: int = K, starts: int = STARTS, iterations: int = ITERATIONS,
        columns: Sequence[str] = SCALED) -> Clusters:
    return fit_all(scaled, [k], starts, iterations, columns)[k]


def assign(scaled: DataFrame, model: Clusters, columns: Sequence[str] = SCALED) -> DataFrame:
    """Add the number of the nearest center."""
    gaps = [
        F.struct(sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(columns, center)),
                     F.lit(0.0)).alias("gap"), F.lit(number).alias("number"))
        for number, center in enumerate(model.centers)
    ]
    nearest = F.least(*gaps) if len(gaps) > 1 else gaps[0]
    return scaled.withColumn("cluster", nearest["number"])


def elbow(scaled: DataFrame, ks: Sequence[int] = ELBOW_KS) -> DataFrame:
    """Inertia by number of clusters."""
    models = fit_all(scaled, ks, ELBOW_STARTS, ELBOW_ITERATIONS)
    rows = [(k, round(m.inertia, 1)) for k, m in models.items()]
    return scaled.sparkSession.createDataFrame(rows, "k INT, inertia DOUBLE")


def silhouette(assigned: DataFrame, sample: int | None = None) -> DataFrame:
    """Mean silhouette by squared distances over all rows; with `sample`, also the Euclidean one
    of so many rows."""
    vectors = features.assemble(assigned, SCALED).select("features", "cluster")
    everything = ClusteringEvaluator(
        featuresCol="features", predictionCol="cluster", metricName="silhouette",
    ).evaluate(vectors)
    if sample is None:
        return assigned.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(round(everything, 3)).alias("silhouette"), "records")
    rows = features.hash_sample(
        assigned.select("fact_id", "cluster", *SCALED), "fact_id", sample)
    return sample_silhouette(rows, SCALED).select(
        F.lit(round(everything, 3)).alias("silhouette"),
        F.round(F.avg("silhouette"), 3).alias("silhouette_sample"),
        F.count(F.lit(1)).alias("sample_records"),
    )


def sample_silhouette(sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Euclidean silhouette of each row of a bounded sample.

    Every task gets the whole sample and measures its own rows against it, so no pairs are
    written; the sample is the bound.
    """
    points = sample.select("cluster", *columns).toPandas()
    labels, coords = points["cluster"].to_numpy(), points[list(columns)].to_numpy(float)
    clusters, sizes = np.unique(labels, return_counts=True)

    def score(batches):
        for pdf in batches:
            x, own = pdf[list(columns)].to_numpy(float), pdf["cluster"].to_numpy()
            distance = np.sqrt(np.maximum(
                (x ** 2).sum(1)[:, None] + (coords ** 2).sum(1) - 2 * x @ coords.T, 0))
            sums = np.stack([distance[:, labels == c].sum(1) for c in clusters], 1)
            mine = own[:, None] == clusters
            n_own = sizes[np.argmax(mine, 1)]
            inner = sums[mine] / np.maximum(n_own - 1, 1)
            outer = np.where(mine, np.inf, sums / sizes).min(1)
            value = (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300)
            yield pd.DataFrame({"silhouette": np.where(n_own > 1, value, 0.0)})

    return sample.repartition(sample.sparkSession.sparkContext.defaultParallelism).mapInPandas(
        score, "silhouette DOUBLE")


def euclidean_silhouette(assigned: DataFrame, columns: Sequence[str] = SCALED, key: str = "fact_id",
                         partners: int = PARTNERS) -> DataFrame:
    """Mean Euclidean silhouette over all rows, with the bound of its error; null if there are no rows.

    Each row is measured against partners of every cluster: all of its members if they are no more than
    `partners`, else about so many, drawn by a hash of the key. If every cluster is taken whole the value
    is exact and the bound 0. Else each row's standard error follows from the spread of its distances,
    and the error of the mean is at most the mean of those, whatever rows share their partners. Rows
    without another one in their cluster, or without another cluster, have a silhouette of 0.
    """
    sizes = {r["cluster"]: r["count"] for r in assigned.groupBy("cluster").count().collect()}
    if not sizes:
        return assigned.sparkSession.createDataFrame(
            [(None, None, 0, True)], "silhouette DOUBLE, error_bound DOUBLE, records BIGINT, exact BOOLEAN")
    share = F.element_at(F.create_map(*[
        F.lit(x) for c, n in sizes.items() for x in (c, min(1.0, partners / n))]), F.col("cluster"))
    rows = assigned.select("cluster", *columns, (
        (share >= 1) | (keyhash.unit_hash("partner", key) < share)).alias("is_partner"))
    drawn = rows.where("is_partner").toPandas()  # about `partners` of each of k clusters
    numbers = sorted(sizes)
    points = [drawn.loc[drawn["cluster"] == c, list(columns)].to_numpy(float) for c in numbers]
    taken = np.array([len(p) for p in points])
    # what is left of the variance of a mean when that share of a cluster is taken
    left = 1 - taken / np.array([sizes[c] for c in numbers])

    # a squared distance is the product of (row, its square, 1) and (-2 partner, 1, its square)
    partner_sides = [np.vstack([-2 * p.T, np.ones(len(p)), (p ** 2).sum(1)]) for p in points]

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        x, own = pdf[list(columns)].to_numpy(float), np.searchsorted(numbers, pdf["cluster"].to_numpy())
        sums, squares = np.empty((2, len(x), len(numbers)))
        length = (x ** 2).sum(1)
        sides = np.column_stack([x, length, np.ones(len(x))])
        for c, (p, side) in enumerate(zip(points, partner_sides)):
            squares[:, c] = np.maximum(len(p) * length - 2 * x @ p.sum(0) + (p ** 2).sum(), 0)
            for k in range(0, len(x), BLOCK):
                distance = sides[k:k + BLOCK] @ side
                np.maximum(distance, 0, out=distance)
                sums[k:k + BLOCK, c] = np.sqrt(distance, out=distance).sum(1)
        mine = np.arange(len(numbers)) == own[:, None]
        # a row is no partner of itself
        n = np.maximum(taken - (mine & pdf["is_partner"].to_numpy()[:, None]), 1)
        mean = sums / n
        error = np.sqrt(np.maximum(squares / n - mean ** 2, 0) / n * left)
        inner, inner_error = mean[mine], error[mine]
        others = np.where(mine, np.inf, mean)
        at = others.argmin(1)[:, None]
        outer, outer_error = np.take_along_axis(others, at, 1)[:, 0], np.take_along_axis(error, at, 1)[:, 0]
        scored = np.isfinite(outer) & (np.array([sizes[c] for c in numbers])[own] > 1)
        outer = np.where(scored, outer, 1.0)
        most = np.maximum(np.maximum(inner, outer), 1e-300)
        # the quotient of the smaller by the larger mean changes by the relative errors of both
        least = np.minimum(inner, outer)
        spread = np.where(inner < outer, inner_error * most + outer_error * least,
                          outer_error * most + inner_error * least) / most ** 2
        return pd.DataFrame({"silhouette": np.where(scored, (outer - inner) / most, 0.0),
                             "error": np.where(scored, spread, 0.0)})

    def score(batches):
        for pdf in batches:
            yield block(pdf)

    whole = all(n <= partners for n in sizes.values())
    return rows.mapInPandas(score, "silhouette DOUBLE, error DOUBLE").agg(
        F.avg("silhouette").alias("silhouette"),
        (F.avg("error") * (0 if whole else DEVIATIONS)).alias("error_bound"),
        F.count(F.lit(1)).alias("records"), F.lit(whole).alias("exact"))


def davies_bouldin(labelled: DataFrame, columns: Sequence[str] = SCALED,
                   label: str = "cluster") -> DataFrame:
    """Mean over the clusters of the worst (spread + spread) / distance with another cluster.

    Two aggregations by cluster; the second measures each row against its own center, which is
    one row per cluster. The pairs of clusters are formed inside one row of k entries.
    """
    centers = labelled.groupBy(label).agg(F.array(*[F.avg(c) for c in columns]).alias("center"))
    # k rows
    spreads = labelled.join(F.broadcast(centers), label).groupBy(label).agg(
        F.first("center").alias("center"),
        F.avg(_distance(F.array(*map(F.col, columns)), F.col("center"))).alias("spread"),
    )
    clusters = F.col("clusters")
    worst = F.transform(clusters, lambda a: F.array_max(F.transform(
        F.filter(clusters, lambda b: b[label] != a[label]),
        lambda b: F.try_divide(a["spread"] + b["spread"], _distance(a["center"], b["center"])))))
    total = F.aggregate(worst, F.lit(0.0), lambda acc, x: acc + x)
    return spreads.agg(F.sort_array(F.collect_list(F.struct(label, "center", "spread")))
                       .alias("clusters")).select(
        F.round(total / F.size(clusters), 3).alias("davies_bouldin_index"))


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def profile(labelled: DataFrame) -> DataFrame:
    """Size, share and unscaled centroid of each cluster."""
    total = F.sum("record_count").over(Window.partitionBy())  # over k rows
    return labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("record_count"),
        exact.ratio(F.sum("sold_qty"), F.count(F.lit(1)), 0).cast("bigint").alias("avg_sold_qty"),
        exact.ratio(F.sum("waste_qty"), F.count(F.lit(1)), 0).cast("bigint")
        .alias("avg_waste_qty"),
        exact.mean(F.col("waste_percentage")).alias("avg_waste_pct"),
        exact.mean(F.col("checkout_price")).alias("avg_checkout_price"),
        exact.mean(F.col("discount_percent")).alias("avg_discount_pct"),
    ).withColumn("percentage_of_catalog", exact.ratio_pct(F.col("record_count"), total, 1))


def top_categories(labelled: DataFrame, n: int = 3) -> DataFrame:
    """The n most frequent categories of each cluster."""
    counts = labelled.groupBy("cluster", "category").agg(F.count(F.lit(1)).alias("record_count"))
    # one row per cluster and category reaches the window
    order = Window.partitionBy("cluster").orderBy(F.desc("record_count"), "category")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def strategy(labelled: DataFrame) -> DataFrame:
    """Archetype name by cluster number and strategy by the unrounded centroid."""
    names = F.array(*map(F.lit, fixed.ARCHETYPES))
    sold, pct, discount = F.avg("sold_qty"), F.avg("waste_percentage"), F.avg("discount_percent")
    advice = labelled.groupBy("cluster").agg(
        F.when((sold > 300) & (pct < 12), fixed.STRATEGY_STAPLE)
        .when(pct >= 14, fixed.STRATEGY_SPOILAGE)
        .when(discount > 15, fixed.STRATEGY_ELASTIC)
        .otherwise(fixed.STRATEGY_NICHE).alias("operational_strategy"))
    return advice.withColumn("name", F.coalesce(
        F.get(names, F.col("cluster")), F.format_string("Cluster %d", F.col("cluster"))))


def scatter(assigned: DataFrame, n: int | None = None) -> DataFrame:
    """First two principal components of all rows, or of n; they are fitted on all rows.

    The input is centered already. Each component points to its largest loading.
    """
    assigned = features.assemble(assigned, SCALED)
    model = PCA(k=2, inputCol="features", outputCol="pca").fit(assigned)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, j]).argmax(), j])) for j in range(2)]
    sample = assigned if n is None else features.hash_sample(assigned, "fact_id", n)
    points = vector_to_array("pca")
    return model.transform(sample).select(
        "fact_id",
        F.round(points[0] * signs[0], 2).alias("x"),
        F.round(points[1] * signs[1], 2).alias("y"),
        "cluster",
        F.col("item_name").alias("item"),
    )
