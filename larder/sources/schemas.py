"""Column contracts of the raw extracts and the star schema."""

RAW_MEALS = "meal_id BIGINT, category STRING, cuisine STRING"
RAW_CENTERS = ("center_id BIGINT, city_code INT, region_code INT, center_type STRING, "
               "op_area DOUBLE")
RAW_ORDERS = ("id BIGINT, week INT, center_id BIGINT, meal_id BIGINT, "
              "checkout_price DECIMAL(12,2), base_price DECIMAL(12,2), "
              "emailer_for_promotion INT, homepage_featured INT, num_orders BIGINT")

FACT_COLUMNS = [
    "date_id", "meal_id", "center_id", "category_id",
    "checkout_price", "base_price", "discount_amount", "discount_percent",
    "emailer_for_promotion", "homepage_featured",
    "sold_qty", "prepared_qty", "waste_qty", "waste_percentage",
    "waste_cost", "revenue", "profit_loss", "waste_risk_tier", "demand_tier",
]

AUDIT_LOG = ("run_timestamp TIMESTAMP, step_name STRING, status STRING, "
             "records_processed BIGINT, execution_time_sec DOUBLE, details STRING")
CATALOG = ("dataset_id BIGINT, name STRING, source_type STRING, provider_source STRING, "
           "source_url STRING, file_path STRING, record_count BIGINT, "
           "column_list ARRAY<STRING>, file_size_kb DOUBLE, import_date DATE, "
           "processing_status STRING, is_deletable BOOLEAN")
