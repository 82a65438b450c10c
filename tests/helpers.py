"""Rows that several test modules make or compare."""

SF_DIR = "/root/testdata/sf0.001"


def facts(spark, rows):
    """Fact rows from (week, meal, center, sold, prepared)."""
    from pyspark.sql import functions as F

    from larder.functions import measures

    df = spark.createDataFrame(
        [(i, 202400 + w, m, c, s, p) for i, (w, m, c, s, p) in enumerate(rows, 1)],
        "fact_id BIGINT, date_id BIGINT, meal_id BIGINT, center_id BIGINT, sold_qty BIGINT, "
        "prepared_qty BIGINT")
    category = {1885: 1, 1230: 2, 77: 3, 2664: 4}
    ids = F.create_map(*[F.lit(x) for pair in category.items() for x in pair])
    return measures.with_measures(df.withColumns({
        "original_record_id": F.col("fact_id"),
        "category_id": F.element_at(ids, F.col("meal_id").cast("int")),
        "checkout_price": F.lit("90.00").cast("decimal(12,2)"),
        "base_price": F.lit("100.00").cast("decimal(12,2)"),
        "emailer_for_promotion": F.lit(0), "homepage_featured": F.lit(0),
        "waste_qty": F.col("prepared_qty") - F.col("sold_qty"),
    }))


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
