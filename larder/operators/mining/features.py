"""Model inputs: features of the joined star, ordinal codes and the train/test split."""

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import keyhash, ranks
from larder.sources.warehouse import Star

NUMERIC = ["checkout_price", "base_price", "discount_amount", "discount_percent",
           "emailer_for_promotion", "homepage_featured", "op_area"]
CATEGORICAL = ["center_type", "category", "cuisine"]
CODES = [f"{name}_code" for name in CATEGORICAL]
FEATURES = NUMERIC + CODES
TRAIN_SHARE = 0.75
# candidate splits per feature, at least; a larger vocabulary raises it, so that an ordinal code can
# be split between any two neighbours
MAX_BINS = 128


def extract(star: Star, cap: int | None = None) -> DataFrame:
    """Features and targets of all facts with known item and center, or of `cap` of them in the
    order of a hash of the key."""
    rows = star.join("item", "center").select(
        "fact_id",
        *[F.col(c).cast("double").alias(c) for c in NUMERIC],
        *CATEGORICAL,
        "demand_tier", "waste_risk_tier", "sold_qty", "waste_qty",
    )
    return rows if cap is None else hash_sample(rows, "fact_id", cap)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows in the order of a hash of the key; each task sends its first n."""
    return df.orderBy(keyhash.unit_hash("sample", key), key).limit(n)


def fit_codes(df: DataFrame) -> StringIndexerModel:
    """Codes 0, 1, ... of the sorted distinct values of each categorical column.

    The vocabularies reach the driver; types, categories and cuisines are few at any table size.
    """
    return StringIndexer(
        inputCols=CATEGORICAL, outputCols=[f"_{c}" for c in CODES],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    ).fit(df)


def bins(codes: StringIndexerModel) -> int:
    """Candidate splits that leave no two neighbouring codes together."""
    return max([MAX_BINS, *(len(labels) + 1 for labels in codes.labelsArray)])


def encode(df: DataFrame, codes: StringIndexerModel) -> DataFrame:
    """Add the code columns as plain numbers; values not seen in fitting get 0."""
    indexed = codes.transform(df)
    plain = {
        name: F.when(F.col(f"_{name}") < len(labels), F.col(f"_{name}")).otherwise(F.lit(0.0))
        for name, labels in zip(CODES, codes.labelsArray)
    }
    return indexed.withColumns(plain).drop(*[f"_{c}" for c in CODES])


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def split(df: DataFrame, key: str, label: str | None = None,
          share: float = TRAIN_SHARE) -> DataFrame:
    """Mark exactly floor(share * n) rows (of each label) as is_train, by a hash of the key.

    The cutoff is an order statistic of the hash, found without ranking the rows of a label in
    one task.
    """
    hashed = df.withColumn("_hash", keyhash.unit_hash("split", key))
    group = F.col(label) if label else F.lit(None).cast("string")
    sizes = {r.g: r.n for r in hashed.groupBy(group.alias("g"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {g: int(share * n) for g, n in sizes.items()}
    cutoffs = ranks.kth_smallest(hashed, "_hash", {g: n for g, n in wanted.items() if n}, label)
    is_train = F.lit(False)
    for g, cutoff in cutoffs.items():
        is_train = is_train | (_is(group, g) & (F.col("_hash") <= F.lit(cutoff)))
    return hashed.withColumn("is_train", is_train).drop("_hash")


def _is(column: Column, value) -> Column:
    return column.eqNullSafe(F.lit(value))
