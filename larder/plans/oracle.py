"""The same results in SQL, written from the definitions, for checking in another engine.

Ratios and means are rounded on whole numbers: half away from zero where the definition is SQL,
half to even where it is a row-level or display rounding.
"""

from larder.plans.queries import PIVOTS, SLICES

# --- rounding ------------------------------------------------------------------------------------


def ratio(num: str, den: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"(sign({num}) * ((abs({num}) * {2 * scale} + ({den})) // (2 * ({den})))"
            f" / {scale}e0)")


def pct(num: str, den: str, digits: int = 2) -> str:
    return ratio(f"(({num}) * 100)", f"nullif({den}, 0)", digits)


def even(num: str, den: str) -> str:
    """num / den to the nearest whole number, ties to the even one."""
    size = f"CAST(abs({num}) AS HUGEINT)"
    whole, rest = f"({size} // ({den}))", f"(2 * ({size} % ({den})))"
    up = f"CASE WHEN {rest} > ({den}) OR ({rest} = ({den}) AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(sign({num}) * ({whole} + {up}))"


def even_pct(num: str, den: str, digits: int = 2) -> str:
    scale = 10 ** digits
    return f"({even(f'(({num}) * {100 * scale})', f'nullif({den}, 0)')} / {scale}e0)"


def mean(column: str, digits: int = 2) -> str:
    """Of a column in hundredths."""
    return f"({ratio(f'sum({column})', f'(count(*) * {10 ** (2 - digits)})', 0)} / {10 ** digits}e0)"


# --- the star ------------------------------------------------------------------------------------

LINE = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
        "l_tax, l_returnflag, l_linestatus, l_shipdate")

DIMENSIONS = """
part_item AS (
  SELECT p_partkey AS meal_id, p_name || ' #' || p_partkey AS item_name,
    ['Fish', 'Seafood', 'Salad', 'Biryani', 'Rice Bowl', 'Soup', 'Pasta', 'Sandwich', 'Pizza',
     'Desert', 'Starters', 'Other Snacks', 'Extras', 'Beverages'
    ][1 + CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 14] AS category,
    ['Thai', 'Indian', 'Italian', 'Continental'][1 + p_size % 4] AS cuisine
  FROM part),
item AS (
  SELECT meal_id, item_name, category, cuisine,
    CASE WHEN category IN ('Salad', 'Fish', 'Seafood', 'Rice Bowl', 'Biryani', 'Soup') THEN 'High'
         WHEN category IN ('Sandwich', 'Pasta', 'Pizza', 'Starters', 'Desert') THEN 'Medium'
         ELSE 'Low' END AS perishability_tier,
    CASE WHEN category IN ('Salad', 'Fish', 'Seafood') THEN 1
         WHEN category IN ('Rice Bowl', 'Biryani', 'Soup') THEN 2
         WHEN category IN ('Sandwich', 'Pasta', 'Pizza', 'Starters') THEN 3
         WHEN category = 'Desert' THEN 5 ELSE 30 END AS shelf_life_days,
    CASE WHEN category IN ('Salad', 'Fish', 'Seafood') THEN 'Cold Storage (0-4°C)'
         WHEN category IN ('Rice Bowl', 'Biryani', 'Soup', 'Sandwich', 'Pasta', 'Pizza',
                           'Starters') THEN 'Chilled Prep (2-5°C)'
         WHEN category = 'Desert' THEN 'Chilled Dessert Cooler'
         ELSE 'Ambient Storage' END AS storage_type
  FROM part_item),
site AS (
  SELECT s_suppkey AS center_id, s_nationkey AS city_code, n_regionkey AS region_code,
    ['TYPE_A', 'TYPE_B', 'TYPE_C'][1 + s_suppkey % 3] AS center_type,
    (9 + s_suppkey * 37 % 62) / 10e0 AS op_area
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
center AS (
  SELECT center_id,
    CASE WHEN op_area >= 5.0 THEN 'Mega' WHEN op_area >= 3.5 THEN 'Urban' ELSE 'Express' END
      || ' Center #' || center_id || ' (City ' || city_code || ')' AS center_name,
    city_code, region_code, center_type, op_area,
    CASE WHEN op_area >= 5.0 THEN 'Mega Distribution Hub'
         WHEN op_area >= 3.5 THEN 'Urban Central Kitchen'
         ELSE 'Express Fulfillment Depot' END AS capacity_tier
  FROM site),
cat AS (
  SELECT CAST(row_number() OVER (ORDER BY min(meal_id)) AS INTEGER) AS category_id,
    category AS category_name,
    CASE WHEN category = 'Beverages' THEN 'Beverages'
         WHEN category IN ('Extras', 'Soup', 'Other Snacks', 'Salad', 'Starters')
           THEN 'Starters & Sides'
         WHEN category = 'Desert' THEN 'Desserts' ELSE 'Mains' END AS food_group,
    CASE WHEN category IN ('Beverages', 'Extras') THEN 'Low'
         WHEN category IN ('Salad', 'Rice Bowl', 'Biryani', 'Fish', 'Seafood') THEN 'High'
         ELSE 'Moderate' END AS spoilage_sensitivity
  FROM part_item GROUP BY category),
weekly AS (
  SELECT CAST(y * 100 + w AS BIGINT) AS date_id, CAST(w AS INTEGER) AS week_number,
    CAST(make_date(y, 1, 1) + CAST(7 * (w - 1) AS INTEGER) AS DATE) AS calendar_date
  FROM (SELECT unnest(range(min(year(l_shipdate)), max(year(l_shipdate)) + 1)) AS y FROM lineitem),
       (SELECT unnest(range(1, 54)) AS w)),
cal AS (
  SELECT date_id, week_number, calendar_date, monthname(calendar_date) AS month_name,
    CAST(month(calendar_date) AS INTEGER) AS month_number,
    'Q' || quarter(calendar_date) AS quarter,
    CAST(year(calendar_date) AS INTEGER) AS year,
    CASE WHEN week_number % 2 = 0 THEN 1 ELSE 0 END AS is_weekend_peak,
    CASE WHEN month(calendar_date) IN (12, 1, 2) THEN 'Winter'
         WHEN month(calendar_date) IN (3, 4, 5) THEN 'Spring'
         WHEN month(calendar_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
  FROM weekly
  WHERE date_id BETWEEN
    (SELECT min(year(l_shipdate) * 100 + (dayofyear(l_shipdate) - 1) // 7 + 1) FROM lineitem)
    AND (SELECT max(year(l_shipdate) * 100 + (dayofyear(l_shipdate) - 1) // 7 + 1) FROM lineitem)
)"""

RATE = """CASE category WHEN 'Fish' THEN 1.21e0 WHEN 'Seafood' THEN 1.19e0 WHEN 'Salad' THEN 1.18e0
    WHEN 'Biryani' THEN 1.15e0 WHEN 'Rice Bowl' THEN 1.14e0 WHEN 'Soup' THEN 1.14e0
    WHEN 'Pasta' THEN 1.12e0 WHEN 'Sandwich' THEN 1.12e0 WHEN 'Pizza' THEN 1.11e0
    WHEN 'Desert' THEN 1.10e0 WHEN 'Starters' THEN 1.11e0 WHEN 'Other Snacks' THEN 1.09e0
    WHEN 'Extras' THEN 1.08e0 WHEN 'Beverages' THEN 1.07e0 ELSE 1.12e0 END"""


def noise_sum(order: str, item: str, center: str, line: str, qty: str) -> str:
    return (f"(({order} * 7919 + {item} * 31 + {line}) % 1009"
            f" + ({item} * 6029 + {center} * 17 + {order}) % 1009"
            f" + ({center} * 4637 + {order} * 13 + {line} * 7) % 1009"
            f" + ({line} * 3571 + {item} * 11 + {qty} * 101) % 1009)")


MEASURES = f"""
  SELECT *,
    greatest(0, base_price - checkout_price) AS discount_amount,
    {even('(CAST(greatest(0, base_price - checkout_price) * 100 AS BIGINT) * 10000)',
          'CAST(greatest(base_price, 1) * 100 AS BIGINT)')}::BIGINT AS disc_h,
    {even('(waste_qty * 10000)', 'greatest(prepared_qty, 1)')}::BIGINT AS pct_h,
    waste_qty * base_price AS waste_cost,
    sold_qty * checkout_price AS revenue,
    CAST({even('CAST((sold_qty * checkout_price - prepared_qty * base_price * 0.42) * 10000 AS HUGEINT)', '100')}
      AS DECIMAL(18,0)) * 0.01 AS profit_loss
  FROM {{rows}}"""

TIERS = """
  SELECT *, pct_h / 100e0 AS waste_percentage, disc_h / 100e0 AS discount_percent,
    CASE WHEN pct_h > 1600 THEN 'HIGH' WHEN pct_h >= 800 THEN 'MEDIUM' ELSE 'LOW' END
      AS waste_risk_tier,
    CASE WHEN sold_qty > 350 THEN 'HIGH' WHEN sold_qty >= 100 THEN 'MEDIUM' ELSE 'LOW' END
      AS demand_tier
  FROM {rows}"""

FACT = f"""
line AS (SELECT *, row_number() OVER (ORDER BY {LINE}) AS fact_id FROM lineitem),
priced AS (
  SELECT fact_id, fact_id AS original_record_id,
    CAST(year(l_shipdate) * 100 + (dayofyear(l_shipdate) - 1) // 7 + 1 AS BIGINT) AS date_id,
    l_partkey AS meal_id, l_suppkey AS center_id, item.category,
    cat.category_id,
    CAST(p_retailprice AS DECIMAL(12,2)) AS base_price,
    CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
      AS DECIMAL(12,2)) AS checkout_price,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS emailer_for_promotion,
    CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN 1 ELSE 0 END AS homepage_featured,
    CAST(l_quantity * 10 AS BIGINT) AS sold_qty,
    {noise_sum('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber',
               'CAST(l_quantity AS BIGINT)')} AS r
  FROM line JOIN part ON l_partkey = p_partkey JOIN item ON l_partkey = meal_id
  JOIN cat ON item.category = cat.category_name),
prepared AS (
  SELECT *, CAST(round_even(sold_qty * least(greatest(
      {RATE} + CASE WHEN emailer_for_promotion + homepage_featured > 0 THEN 0.035e0 ELSE 0e0 END
      + (r - 2016) / 1009e0 * 1.7320508e0 * 0.025e0, 1.03e0), 1.34e0), 0) AS BIGINT)
      AS prepared_qty
  FROM priced),
wasted AS (SELECT *, prepared_qty - sold_qty AS waste_qty FROM prepared),
measured AS ({MEASURES.format(rows='wasted')}),
fact AS ({TIERS.format(rows='measured')})"""

STAR = f"WITH {DIMENSIONS.strip()},{FACT}"
FACT_DIMS = "fact JOIN item USING (meal_id) JOIN center USING (center_id) JOIN cal USING (date_id)"

JOINED = f"""{STAR},
joined AS (
  SELECT fact.* EXCLUDE (category), item.item_name, item.category, item.cuisine,
    center.center_name, center.center_type, center.op_area, center.capacity_tier,
    cal.* EXCLUDE (date_id), cat.category_name, cat.food_group
  FROM fact JOIN item USING (meal_id) JOIN center USING (center_id) JOIN cal USING (date_id)
  JOIN cat USING (category_id))
"""

QTY = """CAST(sum(prepared_qty) AS BIGINT) AS total_prepared,
  CAST(sum(sold_qty) AS BIGINT) AS total_sold, CAST(sum(waste_qty) AS BIGINT) AS total_waste"""
AVG = f"{mean('pct_h')} AS avg_waste_pct"
COST = "CAST(sum(waste_cost) AS DOUBLE) AS total_waste_cost"
REVENUE = "CAST(sum(revenue) AS DOUBLE) AS total_revenue"
TOTALS = f"{QTY}, {AVG}, {COST}, {REVENUE}"
WASTE_PCT = pct("sum(waste_qty)", "sum(prepared_qty)")
PERIOD_PCT = even_pct("sum(waste_qty)", "sum(prepared_qty)")

FACT_OUT = """date_id, meal_id, center_id, category_id,
  CAST(checkout_price AS DOUBLE) AS checkout_price, CAST(base_price AS DOUBLE) AS base_price,
  CAST(discount_amount AS DOUBLE) AS discount_amount, discount_percent,
  emailer_for_promotion, homepage_featured, sold_qty, prepared_qty, waste_qty, waste_percentage,
  CAST(waste_cost AS DOUBLE) AS waste_cost, CAST(revenue AS DOUBLE) AS revenue,
  CAST(profit_loss AS DOUBLE) AS profit_loss, waste_risk_tier, demand_tier"""


def _sources() -> dict[str, str]:
    tables = {
        "region": ["r_regionkey", "r_name"],
        "nation": ["n_nationkey", "n_name", "n_regionkey"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
        "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority"],
        "lineitem": LINE.split(", "),
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        "documents": ["doc_id", "text", "lang", "source", "n_chars"],
        "embeddings": ["vec_id", "embedding", "label"],
        "pages": ["page_id", "url", "html"],
        "benchmark": ["item_id", "text"],
        "labels": ["doc_id", "quality", "toxic"],
        "conversations": ["conv_id", "turn", "role", "text"],
    }
    profile = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS record_count, {len(columns)} AS column_count, "
        f"'{', '.join(columns)}' AS column_list FROM {name}" for name, columns in tables.items())
    catalog = " UNION ALL ".join(
        f"SELECT CAST({1 if name == 'events' else i + (i < 8)} AS BIGINT) AS dataset_id, '{name}' AS name, "
        f"'{'USER_UPLOAD' if name == 'events' else 'EXTERNAL_BENCHMARK'}' AS source_type, "
        f"count(*) AS record_count, '{', '.join(columns)}' AS column_list, "
        f"{len(columns)} AS column_count, {name == 'events'} AS is_deletable FROM {name}"
        for i, (name, columns) in enumerate(tables.items(), 1))
    return {
        "scan_bounded": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
            l_extendedprice FROM lineitem ORDER BY {LINE}""",
        "dim_category": f"{STAR} SELECT * FROM cat",
        "dim_food_item": f"{STAR} SELECT * FROM item",
        "dim_center": f"{STAR} SELECT * FROM center",
        "dim_date": f"{STAR} SELECT * FROM cal",
        "fact_build": f"{STAR} SELECT {FACT_OUT} FROM fact",
        "fact_tiers": f"""{STAR} SELECT waste_risk_tier, demand_tier, count(*) AS record_count
            FROM fact GROUP BY ALL""",
        "surrogate_key": f"SELECT row_number() OVER (ORDER BY {LINE}) AS fact_id, {LINE} FROM lineitem",
        "fact_load": f"""{STAR} SELECT CAST(date_id // 100 AS INTEGER) AS fact_year,
            count(*) AS record_count, min(fact_id) AS first_fact_id, max(fact_id) AS last_fact_id,
            CAST(sum(prepared_qty) AS BIGINT) AS total_prepared,
            CAST(sum(profit_loss) AS DOUBLE) AS total_profit_loss FROM fact GROUP BY 1""",
        "export_extract": f"""{JOINED} SELECT fact_id, week_number, month_name, item_name, category,
            cuisine, center_name, center_type, CAST(checkout_price AS DOUBLE) AS checkout_price,
            CAST(base_price AS DOUBLE) AS base_price, sold_qty, prepared_qty, waste_qty,
            waste_percentage, CAST(waste_cost AS DOUBLE) AS waste_cost,
            CAST(revenue AS DOUBLE) AS revenue FROM joined ORDER BY fact_id LIMIT 2000""",
        "dataset_profile": profile,
        "catalog_list": catalog,
        "warehouse_status": f"""{STAR} SELECT 'ONLINE' AS warehouse_status,
            (SELECT count(*) FROM fact) AS fact_records, (SELECT count(*) FROM item) AS food_items,
            (SELECT count(*) FROM center) AS fulfillment_centers,
            (SELECT count(*) FROM cal) AS date_periods""",
    }


# --- incremental feeds ---------------------------------------------------------------------------

MIXED = """mixed AS (
  SELECT event_id AS row_key,
    CASE WHEN event_type NOT IN ('signup', 'error') THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END
      AS date,
    CASE WHEN event_type = 'signup' THEN CAST(week(ts) AS VARCHAR) END AS week,
    CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR) AS sold,
    json_extract_string(props, '$.k') AS meal, CAST(user_id AS VARCHAR) AS center
  FROM events),
week_ids AS (SELECT week_number AS w, max(date_id) AS week_id FROM cal GROUP BY 1),
placed AS (
  SELECT row_key, CAST(date AS DATE) AS day,
    CASE WHEN date IS NULL THEN coalesce(CAST(week AS INTEGER),
      (SELECT max(week_number) FROM cal) + 1) END AS week_number,
    CASE WHEN date IS NOT NULL THEN 'date' WHEN week IS NOT NULL THEN 'week' ELSE 'next' END
      AS period_source
  FROM mixed),
resolved AS (
  SELECT placed.*, coalesce(
      CASE WHEN day IS NOT NULL THEN coalesce(
        (SELECT max(date_id) FROM cal WHERE calendar_date = day),
        year(day) * 10000 + month(day) * 100 + dayofmonth(day)) END,
      week_id, 202400 + placed.week_number) AS date_id
  FROM placed LEFT JOIN week_ids ON placed.week_number = week_ids.w)"""

# the way of writing the day goes by event_id % 10: 6 has a week only, 7 is unreadable, 9 has nothing
DIRTY = """week_ids AS (SELECT week_number AS w, max(date_id) AS week_id FROM cal GROUP BY 1),
next_week AS (SELECT max(week_number) + 1 AS next FROM cal),
dirty AS (
  SELECT event_id AS row_key,
    CASE event_id % 10 WHEN 6 THEN 'week' WHEN 7 THEN 'unparseable' WHEN 9 THEN 'next'
      ELSE 'date' END AS period_source,
    CAST(CASE event_id % 10 WHEN 7 THEN NULL
      WHEN 6 THEN coalesce((SELECT week_id FROM week_ids WHERE w = week(ts)), 202400 + week(ts))
      WHEN 9 THEN (SELECT 202400 + next FROM next_week)
      ELSE coalesce((SELECT max(date_id) FROM cal WHERE calendar_date = CAST(ts AS DATE)),
        year(ts) * 10000 + month(ts) * 100 + dayofmonth(ts)) END AS BIGINT) AS date_id,
    CASE WHEN event_id % 7 > 2 THEN CAST(floor(value) AS BIGINT) END AS sold_given
  FROM events)"""

FEED = f"""feed AS (
  SELECT event_id AS row_key, CAST(ts AS DATE) AS day,
    CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_id,
    greatest(1, CAST(trunc(value) AS BIGINT)) AS sold_qty,
    coalesce(item.meal_id, (SELECT min(meal_id) FROM item)) AS meal_id,
    coalesce(center.center_id, (SELECT min(center_id) FROM center)) AS center_id,
    CASE WHEN item.meal_id IS NULL THEN 1 ELSE 0 END AS meal_substituted,
    CASE WHEN center.center_id IS NULL THEN 1 ELSE 0 END AS center_substituted,
    coalesce(item.category, (SELECT arg_min(category, meal_id) FROM item)) AS category,
    CAST(285.50 AS DECIMAL(12,2)) AS checkout_price, CAST(310.00 AS DECIMAL(12,2)) AS base_price,
    0 AS emailer_for_promotion, 0 AS homepage_featured
  FROM events LEFT JOIN item ON CAST(json_extract_string(props, '$.k') AS BIGINT) = item.meal_id
  LEFT JOIN center ON user_id = center.center_id),
feed_keyed AS (
  SELECT feed.*, cat.category_id FROM feed JOIN cat ON lower(category) = lower(category_name)),
feed_prepared AS (
  SELECT *, CAST(round_even(sold_qty * least(greatest({RATE}
      + ({noise_sum('row_key', 'meal_id', 'center_id', '1', 'sold_qty')} - 2016)
        / 1009e0 * 1.7320508e0 * 0.02e0, 1.05e0), 1.30e0), 0) AS BIGINT) AS prepared_qty
  FROM feed_keyed),
feed_wasted AS (
  SELECT *, greatest(0, prepared_qty - sold_qty) AS waste_qty FROM feed_prepared),
feed_measured AS ({MEASURES.format(rows='feed_wasted')}),
feed_fact AS ({TIERS.format(rows='feed_measured')})"""

WINDOWS = f"""windows AS (
  SELECT CAST(date_trunc('week', day) AS DATE) AS window_start,
    CAST(date_trunc('week', day) AS DATE) + 7 AS window_end,
    count(*) AS record_count, CAST(sum(prepared_qty) AS BIGINT) AS food_prepared,
    CAST(sum(sold_qty) AS BIGINT) AS food_sold, CAST(sum(waste_qty) AS BIGINT) AS food_wasted,
    {PERIOD_PCT} AS waste_percentage, CAST(sum(waste_cost) AS DOUBLE) AS waste_cost,
    CAST(sum(revenue) AS DOUBLE) AS revenue
  FROM feed_fact GROUP BY 1, 2),
closed AS (
  SELECT * FROM windows WHERE window_end <= (SELECT max(CAST(ts AS DATE)) - 1 FROM events))"""


def _feeds() -> dict[str, str]:
    return {
        "ingest_normalize": f"{STAR}, {MIXED} SELECT row_key, date, week, sold, meal, center FROM mixed",
        "ingest_period": f"""{STAR}, {MIXED} SELECT row_key, CAST(date_id AS BIGINT) AS date_id,
            period_source FROM resolved""",
        "dim_date_upsert": f"""{STAR}, {MIXED},
            fresh AS (SELECT DISTINCT CAST(date_id AS BIGINT) AS date_id, day, week_number,
              coalesce(day, CAST(DATE '2024-01-01' + 7 * (week_number - 1) AS DATE))
                AS calendar_date
              FROM resolved WHERE date_id NOT IN (SELECT date_id FROM cal))
            SELECT date_id,
              CAST(CASE WHEN day IS NULL THEN week_number ELSE week(day) END AS INTEGER)
                AS week_number,
              calendar_date, monthname(calendar_date) AS month_name,
              CAST(month(calendar_date) AS INTEGER) AS month_number,
              'Q' || quarter(calendar_date) AS quarter,
              CAST(CASE WHEN day IS NULL THEN 2024 ELSE year(day) END AS INTEGER) AS year,
              CASE WHEN day IS NOT NULL AND isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend_peak,
              CASE WHEN month(calendar_date) IN (6, 7, 8) THEN 'Summer'
                   WHEN day IS NULL THEN 'Autumn'
                   WHEN month(calendar_date) IN (12, 1, 2) THEN 'Winter'
                   WHEN month(calendar_date) IN (3, 4, 5) THEN 'Spring' ELSE 'Autumn' END AS season
            FROM fresh""",
        "feed_dirty": f"""{STAR}, {DIRTY} SELECT row_key, date_id, period_source, sold_given FROM dirty""",
        "feed_quarantined": f"""{STAR}, {DIRTY} SELECT row_key, 'some day' AS date,
            (SELECT count(*) FROM dirty WHERE date_id IS NULL) AS records_quarantined,
            (SELECT count(*) FROM dirty WHERE date_id IS NOT NULL) AS records_added
            FROM dirty WHERE date_id IS NULL""",
        "ingest_fk_default": f"""{STAR}, {FEED} SELECT row_key, meal_id, center_id, category_id,
            meal_substituted, center_substituted FROM feed_keyed""",
        "ingest_measures": f"""{STAR}, {FEED} SELECT row_key, {FACT_OUT}, meal_substituted,
            center_substituted FROM feed_fact""",
        "ingest_append": f"""{STAR}, {FEED},
            dated AS (
              SELECT date_id // 100 AS year, calendar_date, waste_qty
              FROM fact JOIN cal USING (date_id)
              UNION ALL SELECT year(day), day, waste_qty FROM feed_fact)
            SELECT CAST(year AS INTEGER) AS year, min(calendar_date) AS start_date,
              max(calendar_date) AS end_date, count(*) AS record_count,
              CAST(sum(waste_qty) AS BIGINT) AS total_waste,
              (SELECT count(*) FROM lineitem) AS records_before,
              (SELECT count(*) FROM events) AS records_added,
              (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS total_records,
              (SELECT CAST(sum(center_substituted) AS BIGINT) FROM feed) AS centers_substituted,
              (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS last_record_id
            FROM dated GROUP BY year""",
        "stream_ingest": f"""{STAR}, {FEED} SELECT date_id, count(*) AS record_count,
            CAST(sum(sold_qty) AS BIGINT) AS total_sold,
            CAST(sum(prepared_qty) AS BIGINT) AS total_prepared,
            CAST(sum(center_substituted) AS BIGINT) AS centers_substituted,
            CAST(sum(profit_loss) AS DOUBLE) AS total_profit_loss FROM feed_fact GROUP BY 1""",
        "stream_period_agg": f"{STAR}, {FEED}, {WINDOWS} SELECT * FROM closed",
        "stream_late_windows": f"{STAR}, {FEED}, {WINDOWS} SELECT * FROM windows",
        "stream_early_warning": f"""{STAR}, {FEED}, {WINDOWS},
            pairs AS (SELECT window_start, food_wasted, coalesce(
              lag(food_wasted) OVER (ORDER BY window_start), 0) AS previous_food_wasted FROM closed),
            changed AS (SELECT *, CASE WHEN previous_food_wasted > 0 THEN
              {even_pct('food_wasted - previous_food_wasted', 'previous_food_wasted', 1)} END
              AS waste_change_pct FROM pairs)
            SELECT *, {DISPLAY} AS change_display, {STATUS} AS status FROM changed""",
    }


# --- OLAP, reports, charts -----------------------------------------------------------------------

def _olap() -> dict[str, str]:
    by = "category, cuisine, center_type, month_name"
    columns = {"category": "category_name"}
    found = {
        f"olap_slice_{dim}": f"""{JOINED} SELECT {by}, count(*) AS total_records, {TOTALS}
            FROM joined WHERE {columns.get(dim, dim)} = '{value}' GROUP BY {by}
            ORDER BY total_waste DESC, {by} LIMIT 100""" for dim, value in SLICES.items()
    }
    detail = """fact_id, week_number, month_name, quarter, item_name, category, cuisine,
        center_name, center_type, prepared_qty, sold_qty, waste_qty, waste_percentage AS waste_pct,
        CAST(waste_cost AS DOUBLE) AS waste_cost, CAST(revenue AS DOUBLE) AS revenue,
        waste_risk_tier"""
    # the alias must not shadow the decimal in the ORDER BY of the detail rows
    found["olap_dice"] = f"""{JOINED} SELECT {detail} FROM joined WHERE cuisine = 'Indian'
        AND center_type = 'TYPE_B' AND quarter = 'Q2' AND waste_risk_tier = 'HIGH'
        ORDER BY joined.waste_cost DESC, fact_id LIMIT 100"""
    found["olap_dice_all"] = f"""{JOINED} SELECT {detail} FROM joined
        ORDER BY joined.waste_cost DESC, fact_id LIMIT 100"""
    levels = {
        "week": "year, week_number AS time_dimension", "month": "year, month_name AS time_dimension",
        "quarter": "year, quarter AS time_dimension", "year": "year, year AS time_dimension",
        "cuisine": "cuisine AS grouping_dimension",
        "center_type": "center_type AS grouping_dimension",
        "category": "category_name AS grouping_dimension, food_group",
    }
    groups = {"week": "year, week_number", "month": "year, month_name, month_number",
              "quarter": "year, quarter", "year": "year", "cuisine": "cuisine",
              "center_type": "center_type", "category": "category_name, food_group"}
    for level, select in levels.items():
        found[f"olap_rollup_{level}"] = f"""{JOINED} SELECT {select}, count(*) AS record_count,
            {TOTALS} FROM joined GROUP BY {groups[level]}"""
    found["olap_rollup_hierarchy"] = f"""{JOINED} SELECT year, quarter, month_number,
        CAST(GROUPING(year, quarter, month_number) AS INTEGER) AS level, count(*) AS record_count,
        {TOTALS} FROM joined GROUP BY ROLLUP (year, quarter, month_number)"""
    found["olap_drilldown_category"] = f"""{STAR} SELECT meal_id, item_name, cuisine,
        perishability_tier, count(*) AS center_weeks_recorded, {TOTALS}
        FROM (SELECT * EXCLUDE (category) FROM fact) JOIN item USING (meal_id)
        WHERE category = 'Biryani' GROUP BY 1, 2, 3, 4"""
    found["olap_drilldown_center"] = f"""{STAR} SELECT center_id, center_name, city_code, op_area,
        count(*) AS total_records, {QTY}, {AVG}, {COST} FROM fact JOIN center USING (center_id)
        WHERE center_type = 'TYPE_B' GROUP BY 1, 2, 3, 4
        ORDER BY total_waste DESC, center_id LIMIT 25"""
    labels = {"center_type": ["TYPE_A", "TYPE_B", "TYPE_C"], "quarter": ["Q1", "Q2", "Q3", "Q4"]}
    for name, (row, column, metric) in PIVOTS.items():
        cells, total = [], []
        for label in labels[column]:
            match = f"FILTER (WHERE {column} = '{label}')"
            if metric in ("waste_cost", "revenue"):
                cell = f"CAST(coalesce(sum({metric}) {match}, 0) AS DOUBLE)"
            elif metric == "waste_percentage":
                cell = (f"coalesce(((2 * sum(pct_h) {match} + count(*) {match})"
                        f" // (2 * count(*) {match})) / 100e0, 0)")
            else:
                cell = f"CAST(coalesce(sum({metric}) {match}, 0) AS BIGINT)"
            cells.append(f"{cell} AS {label}")
            total.append(label)
        sum_cells = " + ".join(total)
        if metric not in ("waste_qty", "sold_qty"):
            sum_cells = f"round({sum_cells}, 2)"
        found[name] = f"""{JOINED}, cells AS (SELECT {row} AS label, {', '.join(cells)}
            FROM joined GROUP BY {row}) SELECT *, {sum_cells} AS total FROM cells"""
    return found


def _reports() -> dict[str, str]:
    cards = f"""SELECT category_name, food_group, spoilage_sensitivity,
        count(*) AS total_observations, CAST(sum(prepared_qty) AS BIGINT) AS prepared_units,
        CAST(sum(sold_qty) AS BIGINT) AS sold_units, CAST(sum(waste_qty) AS BIGINT) AS wasted_units,
        {WASTE_PCT} AS waste_percentage, CAST(sum(waste_cost) AS DOUBLE) AS waste_cost_dollars,
        CAST(sum(revenue) AS DOUBLE) AS revenue_dollars,
        CASE WHEN sum(waste_qty) * 100 > sum(prepared_qty) * 14 THEN 'URGENT INTERVENTION'
             WHEN sum(waste_qty) * 100 > sum(prepared_qty) * 10 THEN 'ATTENTION NEEDED'
             ELSE 'OPTIMAL EFFICIENCY' END AS efficiency_rating
        FROM fact JOIN cat USING (category_id) GROUP BY 1, 2, 3"""
    browse = """SELECT original_record_id, week_number, month_name, item_name, category, cuisine,
        center_name, center_type, CAST(base_price AS DOUBLE) AS base_price,
        CAST(checkout_price AS DOUBLE) AS checkout_price, discount_percent, emailer_for_promotion,
        homepage_featured, sold_qty, prepared_qty, waste_qty, waste_percentage,
        CAST(waste_cost AS DOUBLE) AS waste_cost FROM joined"""
    search = ("item_name ILIKE '%fish%' OR category ILIKE '%fish%' "
              "OR center_name ILIKE '%fish%'")
    items = "(SELECT * EXCLUDE (category) FROM fact) JOIN item USING (meal_id)"
    return {
        "kpi_summary": f"""{STAR} SELECT count(*) AS total_records,
            CAST(sum(prepared_qty) AS BIGINT) AS total_food_prepared,
            CAST(sum(sold_qty) AS BIGINT) AS total_food_sold,
            CAST(sum(waste_qty) AS BIGINT) AS total_food_wasted,
            {WASTE_PCT} AS overall_waste_percentage, {COST}, {REVENUE},
            CAST(sum(profit_loss) AS DOUBLE) AS total_profit_loss,
            (SELECT count(*) FROM center) AS active_fulfillment_centers,
            (SELECT count(*) FROM item) AS monitored_menu_items FROM fact""",
        "chart_monthly": f"""{STAR} SELECT month_name, month_number,
            CAST(sum(sold_qty) AS BIGINT) AS demand_sold,
            CAST(sum(prepared_qty) AS BIGINT) AS food_prepared,
            CAST(sum(waste_qty) AS BIGINT) AS food_wasted, {mean('pct_h')} AS waste_pct
            FROM fact JOIN cal USING (date_id) GROUP BY 1, 2""",
        "chart_top_wasted": f"""{STAR} SELECT item_name, category, cuisine,
            CAST(sum(waste_qty) AS BIGINT) AS total_waste_units, {COST}, {AVG}
            FROM {items} GROUP BY 1, 2, 3
            ORDER BY total_waste_units DESC, item_name, category, cuisine LIMIT 8""",
        "chart_cuisine": f"""{STAR} SELECT cuisine, CAST(sum(prepared_qty) AS BIGINT) AS prepared,
            CAST(sum(sold_qty) AS BIGINT) AS sold, CAST(sum(waste_qty) AS BIGINT) AS waste,
            {WASTE_PCT} AS waste_pct, CAST(sum(waste_cost) AS DOUBLE) AS cost
            FROM {items} GROUP BY 1""",
        "chart_center_type": f"""{STAR} SELECT center_type,
            count(DISTINCT center_id) AS center_count, CAST(sum(sold_qty) AS BIGINT) AS sold,
            CAST(sum(waste_qty) AS BIGINT) AS waste, {WASTE_PCT} AS waste_pct
            FROM fact JOIN center USING (center_id) GROUP BY 1""",
        "chart_risk_tier": f"""{STAR} SELECT waste_risk_tier, count(*) AS record_count,
            {pct('count(*)', '(SELECT count(*) FROM fact)', 1)} AS percentage
            FROM fact GROUP BY 1""",
        "report_category_scorecard": f"{STAR} {cards}",
        "report_top_centers": f"""{STAR} SELECT center_id, center_name, center_type, op_area,
            CAST(sum(waste_qty) AS BIGINT) AS wasted_units, {WASTE_PCT} AS waste_percentage,
            CAST(sum(waste_cost) AS DOUBLE) AS waste_cost_dollars
            FROM fact JOIN center USING (center_id) GROUP BY 1, 2, 3, 4
            ORDER BY sum(waste_cost) DESC, center_id LIMIT 10""",
        "report_savings": f"""{STAR}, costs AS (SELECT category_id, sum(waste_cost) AS c FROM fact
            GROUP BY 1) SELECT count(*) AS total_categories_audited,
            CAST(sum(c) AS DOUBLE) AS total_waste_cost,
            CAST(round(sum(c) * 0.25, 2) AS DOUBLE) AS projected_savings_target FROM costs""",
        "browse_page": f"{JOINED} {browse} WHERE {search} ORDER BY fact_id LIMIT 20 OFFSET 40",
        "browse_after": f"{JOINED} {browse} WHERE fact_id > 1000 ORDER BY fact_id LIMIT 20",
        "browse_count": f"""{JOINED} SELECT count(*) AS total_records,
            (count(*) + 19) // 20 AS total_pages FROM joined WHERE {search}""",
        "insight_high_waste": f"""{STAR} SELECT item_name, category,
            {mean('pct_h', 1)} AS avg_waste_pct, CAST(sum(waste_qty) AS BIGINT) AS total_wasted,
            CAST(sum(waste_cost) AS DOUBLE) AS monetary_loss FROM {items} GROUP BY 1, 2
            ORDER BY avg_waste_pct DESC, item_name, category LIMIT 3""",
        "insight_peak_periods": f"""{STAR} SELECT month_name, quarter,
            CAST(sum(sold_qty) AS BIGINT) AS total_orders, {mean('pct_h', 1)} AS waste_pct
            FROM fact JOIN cal USING (date_id) GROUP BY 1, 2
            ORDER BY total_orders DESC, month_name LIMIT 2""",
    }


# --- periods -------------------------------------------------------------------------------------

DATED = f"{STAR}, dated AS (SELECT * FROM fact JOIN cal USING (date_id))"
PERIOD = f"""count(*) AS record_count,
    CAST(coalesce(sum(prepared_qty), 0) AS BIGINT) AS food_prepared,
    CAST(coalesce(sum(sold_qty), 0) AS BIGINT) AS food_sold,
    CAST(coalesce(sum(waste_qty), 0) AS BIGINT) AS food_wasted,
    coalesce({PERIOD_PCT}, 0e0) AS waste_percentage,
    CAST(coalesce(sum(waste_cost), 0) AS DOUBLE) AS waste_cost,
    CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS revenue"""
METRICS = ["record_count", "food_prepared", "food_sold", "food_wasted", "waste_percentage",
           "waste_cost", "revenue"]
STATUS = """CASE WHEN waste_change_pct >= 15.0 THEN 'CRITICAL'
    WHEN waste_change_pct >= 5.0 THEN 'WARNING' ELSE 'NORMAL' END"""
DISPLAY = """CASE WHEN waste_change_pct IS NULL THEN 'N/A (Baseline)'
    WHEN waste_change_pct > 0 THEN printf('%+.1f%%', waste_change_pct)
    ELSE printf('%.1f%%', waste_change_pct) END"""


def compared(by: str, match: str, current: str, previous: str) -> str:
    """All periods of a grain with their predecessors (p) and the changes."""
    earlier = ", ".join(f"coalesce(p.{m}, 0) AS previous_{m}" for m in METRICS)

    def change(name, column):
        return (f"CASE WHEN previous_{column} > 0 THEN "
                f"{even_pct(f'{column} - previous_{column}', f'previous_{column}', 1)} END AS {name}")

    return f"""{DATED},
      per AS (SELECT {by}, {PERIOD} FROM dated GROUP BY {by}),
      pairs AS (SELECT c.*, {earlier}, {current} AS current_period_label,
        {previous} AS previous_period_label FROM per c LEFT JOIN per p ON {match}),
      changed AS (SELECT *, food_wasted - previous_food_wasted AS waste_change_qty,
        {change('waste_change_pct', 'food_wasted')}, {change('prep_change_pct', 'food_prepared')},
        {change('sold_change_pct', 'food_sold')},
        (CAST(round(waste_percentage * 100) AS BIGINT)
          - CAST(round(previous_waste_percentage * 100) AS BIGINT)) / 100e0 AS waste_pct_diff
        FROM pairs),
      compared AS (SELECT *, {DISPLAY} AS change_display, {STATUS} AS status FROM changed)"""


def _periods() -> dict[str, str]:
    data = """min(calendar_date) AS start_date, max(calendar_date) AS end_date,
        count(*) AS record_count, CAST(sum(waste_qty) AS BIGINT) AS total_waste FROM dated"""
    months = ("['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', "
              "'September', 'October', 'November', 'December']")
    week_labels = ("'Week ' || c.week_number",
                   "'Week ' || (c.week_number - 1) || ' (Previous Week)'")
    month_labels = (f"'Month of ' || {months}[c.month_number]",
                    f"'Month of ' || {months}[(c.month_number + 10) % 12 + 1] || "
                    "' (Previous Month)'")
    weekly_by_year = compared("year, week_number",
                              "p.year = c.year AND p.week_number = c.week_number - 1", *week_labels)
    daily_match = """p.calendar_date = (SELECT max(e.calendar_date) FROM per e
        WHERE e.calendar_date < c.calendar_date)"""
    signed = "printf('%+.1f%%', waste_change_pct)"
    units = ("CASE WHEN waste_change_qty >= 0 THEN '+' ELSE '' END || "
             "format('{:,}', waste_change_qty)")
    message = f"""CASE
        WHEN waste_change_pct IS NULL AND previous_record_count = 0 THEN 'Baseline period selected. Awaiting prior historical records for automated delta detection.'
        WHEN waste_change_pct IS NULL THEN 'Food waste is within normal operational thresholds.'
        WHEN waste_change_pct >= 15 THEN 'Food waste has increased significantly compared with the previous period. Immediate review is recommended.'
        WHEN waste_change_pct >= 5 THEN 'Food waste has moderately increased compared with the previous period. Preventive buffer review advised.'
        ELSE 'Food waste is well controlled (' || {signed} || ') and within acceptable operational thresholds.' END"""
    details = f"""CASE
        WHEN waste_change_pct IS NULL AND previous_record_count = 0 THEN 'No prior records exist for this exact timeframe. Operational measures recorded as baseline.'
        WHEN waste_change_pct IS NULL THEN 'Food waste metrics align with baseline operating expectations.'
        WHEN waste_change_pct >= 15 THEN 'Significant waste surge detected: Waste increased by ' || {signed} || ' (' || {units} || ' units) versus the prior period. Immediate kitchen prep calibration and inventory safety buffer audit strongly recommended.'
        WHEN waste_change_pct >= 5 THEN 'Elevated waste detected: Food waste increased by ' || {signed} || ' (' || {units} || ' units). Monitor recipe prep volumes and discount promotions.'
        ELSE 'Food waste remains stable compared to previous period (' || {signed} || '). Preparation and customer demand are well synchronized.' END"""
    custom = compared("CASE WHEN calendar_date >= DATE '1998-03-01' THEN 1 ELSE 0 END AS side",
                      "p.side = 0",
                      "'Custom Range (1998-03-01 to 1998-05-31)'",
                      "'Previous Equivalent Range (1997-11-29 to 1998-02-28)'")
    custom = custom.replace(
        "FROM dated GROUP BY CASE WHEN calendar_date >= DATE '1998-03-01' THEN 1 ELSE 0 END AS side",
        "FROM dated WHERE calendar_date BETWEEN DATE '1997-11-29' AND DATE '1998-05-31' GROUP BY 1")
    def card(pairs, by=""):
        return f"""{pairs} SELECT {by}current_period_label,
            previous_period_label, format('{{:,}}', food_wasted) AS current_waste_display,
            format('{{:,}}', previous_food_wasted) AS previous_waste_display, change_display, status,
            CASE status WHEN 'CRITICAL' THEN '🔴 Critical' WHEN 'WARNING' THEN '🟡 Warning'
              ELSE '🟢 Normal' END AS badge,
            {message} AS message, {details} AS details FROM compared"""

    daily = compared(
        "calendar_date", daily_match, "'Date: ' || CAST(c.calendar_date AS VARCHAR)",
        "CASE WHEN p.calendar_date IS NULL THEN 'Previous Date (No Prior Record)' ELSE "
        "'Previous Logged Date (' || CAST(p.calendar_date AS VARCHAR) || ')' END")
    monthly_by_year = compared(
        "year, month_number", "p.year * 12 + p.month_number = c.year * 12 + c.month_number - 1",
        *month_labels)
    yearly = compared("year", "p.year = c.year - 1", "'Year ' || c.year",
                      "'Year ' || (c.year - 1) || ' (Previous Year)'")
    return {
        "early_warning_daily": card(daily, "calendar_date, "),
        "early_warning_monthly": card(monthly_by_year, "year, month_number, "),
        "early_warning_yearly": card(yearly, "year, "),
        "early_warning_custom": card(custom) + " WHERE side = 1",
        "period_weeks": f"{DATED} SELECT week_number, month_name, year, {data} GROUP BY 1, 2, 3",
        "period_months": f"{DATED} SELECT month_name, month_number, year, {data} GROUP BY 1, 2, 3",
        "period_years": f"{DATED} SELECT year, {data} GROUP BY 1",
        "period_dates": f"{DATED} SELECT DISTINCT calendar_date FROM dated",
        "period_bounds": f"""{DATED} SELECT min(calendar_date) AS min_date,
            max(calendar_date) AS max_date,
            (SELECT week_number FROM dated ORDER BY year DESC, week_number DESC LIMIT 1)
              AS latest_week,
            (SELECT month_name FROM dated ORDER BY year DESC, month_number DESC LIMIT 1)
              AS latest_month,
            max(year) AS latest_year, max(calendar_date) AS latest_date FROM dated""",
        "period_measures": f"""{DATED} SELECT {PERIOD} FROM dated
            WHERE calendar_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'""",
        "period_compare_daily": daily + " SELECT * FROM compared",
        "period_compare_weekly": compared(
            "week_number", "p.week_number = c.week_number - 1", *week_labels)
        + " SELECT * FROM compared",
        "period_compare_weekly_by_year": weekly_by_year + " SELECT * FROM compared",
        "period_compare_monthly": compared(
            "month_number", "p.month_number = (c.month_number + 10) % 12 + 1", *month_labels)
        + " SELECT * FROM compared",
        "period_compare_monthly_by_year": monthly_by_year + " SELECT * FROM compared",
        "period_compare_yearly": yearly + " SELECT * FROM compared",
        "period_compare_custom": custom + " SELECT * EXCLUDE (side) FROM compared WHERE side = 1",
        "early_warning": card(weekly_by_year, "year, week_number, "),
    }


# --- mining --------------------------------------------------------------------------------------

def _baskets(item: str, min_support: float) -> str:
    return f"""WITH baskets AS (SELECT DISTINCT l_orderkey AS basket_id, {item} AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey),
      n AS (SELECT count(DISTINCT basket_id) AS n FROM baskets),
      items AS (SELECT item, count(*) AS basket_count, count(*) / CAST(any_value(n) AS DOUBLE)
        AS support FROM baskets, n GROUP BY item HAVING support >= {min_support}),
      frequent AS (SELECT baskets.* FROM baskets JOIN items USING (item)),
      pairs AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS basket_count,
        count(*) / CAST(any_value(n) AS DOUBLE) AS support
        FROM frequent a JOIN frequent b ON a.basket_id = b.basket_id AND a.item < b.item, n
        GROUP BY 1, 2 HAVING support >= {min_support})"""


SETS = """WITH RECURSIVE baskets AS (SELECT DISTINCT l_orderkey AS basket_id, p_type AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey),
      n AS (SELECT CAST(count(DISTINCT basket_id) AS DOUBLE) AS n FROM baskets),
      parts AS (SELECT basket_id, [item] AS items FROM baskets UNION ALL
        SELECT p.basket_id, list_append(p.items, b.item) FROM parts p JOIN baskets b
          ON p.basket_id = b.basket_id AND b.item > p.items[-1]),
      sets AS (SELECT items, count(*) AS basket_count, count(*) / any_value(n) AS support FROM parts, n
        GROUP BY items HAVING support >= 0.02)"""

RULES = f"""{_baskets('p_type', 0.2)},
      both_ways AS (SELECT item_a AS antecedent, item_b AS consequent, support FROM pairs
        UNION ALL SELECT item_b, item_a, support FROM pairs),
      measured AS (SELECT antecedent, consequent, r.support, x.support AS sx, y.support AS sy,
        r.support / x.support AS confidence, r.support / x.support / y.support AS lift
        FROM both_ways r JOIN items x ON antecedent = x.item JOIN items y ON consequent = y.item),
      rules AS (SELECT antecedent, consequent, round(support, 3) AS support,
        round(support * 100, 1) AS support_pct, round(confidence, 3) AS confidence,
        round(confidence * 100, 1) AS confidence_pct, round(lift, 2) AS lift,
        round(support - sx * sy, 4) AS leverage,
        round(CASE WHEN confidence < 1 THEN (1 - sy) / (1 - confidence) ELSE 99e0 END, 2)
          AS conviction,
        'When customers order ''' || antecedent || ''', '
          || CAST(round_even(confidence * 100, 0) AS BIGINT) || '% simultaneously purchase '''
          || consequent || '''. Pre-pack in dynamic combo bundles to synchronize shelf life and '
          || 'eliminate unsold side-item spoilage.' AS waste_mitigation_strategy
        FROM measured WHERE confidence >= 0.3 AND lift >= 0)"""

RULED_TIERS = f"""{STAR}, ruled AS (SELECT demand_tier AS actual,
    CASE WHEN emailer_for_promotion + homepage_featured > 0 THEN 'HIGH'
         WHEN checkout_price >= 930 THEN 'LOW' ELSE 'MEDIUM' END AS predicted FROM fact),
  grid AS (SELECT a AS actual, p AS predicted FROM (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) AS a),
    (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) AS p)),
  counts AS (SELECT grid.*, (SELECT count(*) FROM ruled r WHERE r.actual = grid.actual
    AND r.predicted = grid.predicted) AS n FROM grid)"""

LABELLED = f"""{STAR}, labelled AS (
  SELECT fact.* EXCLUDE (category), item.category,
    CASE WHEN sold_qty > 300 THEN 0 ELSE 2 END + CASE WHEN pct_h >= 1200 THEN 1 ELSE 0 END
      AS cluster
  FROM fact JOIN item USING (meal_id))"""

Z_COLUMNS = ["sold_qty", "waste_qty", "waste_percentage", "checkout_price", "discount_percent"]


def _mining() -> dict[str, str]:
    z = ", ".join(
        f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) "
        f"/ stddev_pop(CAST({c} AS DOUBLE)) OVER () AS z_{c}" for c in Z_COLUMNS)
    centers = ", ".join(f"avg(z_{c}) AS c_{c}" for c in Z_COLUMNS)
    to_center = " + ".join(f"(z_{c} - c_{c}) ** 2" for c in Z_COLUMNS)
    between = " + ".join(f"(a.c_{c} - b.c_{c}) ** 2" for c in Z_COLUMNS)
    centers_kept = ", ".join(f"any_value(c_{c}) AS c_{c}" for c in Z_COLUMNS)
    n = "count(*)"
    return {
        "item_support": f"""{_baskets('p_name', 0.05)} SELECT item, basket_count,
            round(support, 4) AS support FROM items""",
        "pair_support": f"""{_baskets('p_type', 0.2)} SELECT item_a, item_b, basket_count,
            round(support, 4) AS support FROM pairs""",
        "itemsets": f"""{SETS} SELECT array_to_string(items, ' + ') AS itemset, CAST(len(items) AS INTEGER) AS size,
            basket_count, round(support, 4) AS support FROM sets""",
        "itemset_rules": f"""{SETS}, ways AS (SELECT list_filter(items, lambda x: x <> c) AS antecedent, c AS consequent, support
              FROM (SELECT items, unnest(items) AS c, support FROM sets WHERE len(items) > 2)),
            measured AS (SELECT w.*, w.support / a.support AS confidence, w.support / a.support / o.support AS lift
              FROM ways w JOIN sets a ON a.items = w.antecedent JOIN sets o ON o.items = [w.consequent])
            SELECT array_to_string(antecedent, ' + ') AS antecedent, consequent, round(support, 4) AS support,
              round(confidence, 4) AS confidence, round(lift, 3) AS lift FROM measured WHERE confidence >= 0.3""",
        **{f"distinct_meals_by_{name}": f"""{STAR} SELECT cal.{period}, center.center_type, count(DISTINCT meal_id) AS meals,
            true AS within_2_pct FROM fact JOIN center USING (center_id) JOIN cal USING (date_id) GROUP BY ALL"""
           for name, period in (("year", "year"), ("month", "month_name"))},
        "sql_rows": f"""{STAR} SELECT cuisine, item.category, count(*) AS record_count,
            CAST(sum(sold_qty) AS BIGINT) AS total_sold FROM fact JOIN item USING (meal_id)
            WHERE cuisine = 'Thai' AND sold_qty >= 200 GROUP BY ALL""",
        "sql_scalar": f"{STAR} SELECT count(*) AS other_items FROM item",
        "assoc_rules": f"{RULES} SELECT * FROM rules",
        "assoc_rules_top": f"""{RULES} SELECT * FROM rules
            ORDER BY lift DESC, confidence DESC, antecedent, consequent LIMIT 15""",
        "features": f"""{JOINED} SELECT fact_id, CAST(checkout_price AS DOUBLE) AS checkout_price,
            CAST(base_price AS DOUBLE) AS base_price,
            CAST(discount_amount AS DOUBLE) AS discount_amount, discount_percent,
            CAST(emailer_for_promotion AS DOUBLE) AS emailer_for_promotion,
            CAST(homepage_featured AS DOUBLE) AS homepage_featured, op_area, center_type, category,
            cuisine, demand_tier, waste_risk_tier, sold_qty FROM joined""",
        "encode": f"""{JOINED} SELECT fact_id,
            CAST(dense_rank() OVER (ORDER BY center_type) - 1 AS DOUBLE) AS center_type_code,
            CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS category_code,
            CAST(dense_rank() OVER (ORDER BY cuisine) - 1 AS DOUBLE) AS cuisine_code FROM joined""",
        "split": f"""{STAR}, sizes AS (SELECT demand_tier, count(*) AS n FROM fact GROUP BY 1)
            SELECT demand_tier, true AS is_train, n * 3 // 4 AS record_count FROM sizes
            UNION ALL SELECT demand_tier, false, n - n * 3 // 4 FROM sizes""",
        "clf_metrics": f"""{RULED_TIERS},
            per AS (SELECT l, sum(n) FILTER (WHERE actual = l AND predicted = l) AS hits,
              sum(n) FILTER (WHERE actual = l) AS act, sum(n) FILTER (WHERE predicted = l) AS pre,
              sum(n) AS total FROM counts, (SELECT unnest(['LOW', 'MEDIUM', 'HIGH']) AS l)
              GROUP BY l)
            SELECT CAST(any_value(total) AS BIGINT) AS test_records,
              {pct('sum(hits)', 'any_value(total)')} AS accuracy,
              round(sum(act / total * coalesce(hits / nullif(pre, 0), 0)) * 100, 2) AS precision,
              round(sum(act / total * coalesce(hits / nullif(act, 0), 0)) * 100, 2) AS recall,
              round(sum(act / total * coalesce(2 * hits / nullif(act + pre, 0), 0)) * 100, 2)
                AS f1_score FROM per""",
        "confusion_matrix": f"""{RULED_TIERS} SELECT coalesce(actual, 'TOTAL') AS actual,
            coalesce(predicted, 'TOTAL') AS predicted, CAST(sum(n) AS BIGINT) AS n FROM counts
            GROUP BY CUBE (actual, predicted)""",
        "reg_metrics": f"""{STAR}, ruled AS (SELECT sold_qty AS y,
              sold_qty - (230 + 40 * (emailer_for_promotion + homepage_featured)) AS e FROM fact),
            sums AS (SELECT count(*) AS n, CAST(sum(y) AS DOUBLE) AS y, CAST(sum(y * y) AS DOUBLE)
              AS yy, CAST(sum(e * e) AS DOUBLE) AS ee, CAST(sum(abs(e)) AS DOUBLE) AS ae FROM ruled)
            SELECT n AS test_records, round(1 - ee / (yy - y * y / n), 4) AS r2_score,
              round(sqrt(ee / n), 2) AS rmse, round(ae / n, 2) AS mae,
              round(y / n, 1) AS mean_actual_demand FROM sums""",
        "prep_sizing": f"""{STAR}, sized AS (
              SELECT fact_id, base_price, checkout_price, greatest(10, sold_qty) AS d,
                item.category IN ('Salad', 'Fish', 'Seafood', 'Rice Bowl', 'Biryani') AS fresh
              FROM fact JOIN item USING (meal_id)),
            prepped AS (SELECT *, CAST(round_even(
              d * CASE WHEN fresh THEN 1.08e0 ELSE 1.12e0 END, 0) AS BIGINT) AS prep FROM sized)
            SELECT fact_id, CAST(d AS BIGINT) AS forecasted_demand,
              prep AS recommended_preparation_qty,
              CASE WHEN fresh THEN 8e0 ELSE 12e0 END AS recommended_safety_buffer_pct,
              prep - d AS estimated_surplus_waste_units,
              {even_pct('prep - d', 'prep')} AS projected_waste_percentage,
              CAST((prep - d) * base_price AS DOUBLE) AS estimated_waste_cost,
              CAST(d * checkout_price AS DOUBLE) AS projected_revenue,
              'Preparing ' || prep || ' units maintains a ' || CASE WHEN fresh THEN 8 ELSE 12 END
                || '% buffer to absorb peak orders while capping projected waste to under '
                || printf('%.1f', {even_pct('prep - d', 'prep', 1)}) || '%.' AS waste_optimization_note
            FROM prepped""",
        "standardize": f"""{STAR}, scaled AS (SELECT fact_id, {z} FROM fact)
            SELECT fact_id, {', '.join(f'round(z_{c}, 4) AS z_{c}' for c in Z_COLUMNS)}
            FROM scaled""",
        "davies_bouldin": f"""{LABELLED}, scaled AS (SELECT cluster, {z} FROM labelled),
            centers AS (SELECT cluster, {centers} FROM scaled GROUP BY 1),
            spreads AS (SELECT cluster, {centers_kept}, avg(sqrt({to_center})) AS spread
              FROM scaled JOIN centers USING (cluster) GROUP BY 1),
            worst AS (SELECT a.cluster, max((a.spread + b.spread) / sqrt({between})) AS w
              FROM spreads a JOIN spreads b ON a.cluster <> b.cluster GROUP BY 1)
            SELECT round(avg(w), 3) AS davies_bouldin_index FROM worst""",
        "cluster_profile": f"""{LABELLED} SELECT cluster, {n} AS record_count,
            CAST({ratio('sum(sold_qty)', n, 0)} AS BIGINT) AS avg_sold_qty,
            CAST({ratio('sum(waste_qty)', n, 0)} AS BIGINT) AS avg_waste_qty,
            {mean('pct_h')} AS avg_waste_pct,
            {mean('CAST(checkout_price * 100 AS BIGINT)')} AS avg_checkout_price,
            {mean('disc_h')} AS avg_discount_pct,
            {pct(n, '(SELECT count(*) FROM labelled)', 1)} AS percentage_of_catalog
            FROM labelled GROUP BY 1""",
        "cluster_top_categories": f"""{LABELLED} SELECT cluster, category,
            count(*) AS record_count, CAST(row_number() OVER (PARTITION BY cluster
              ORDER BY count(*) DESC, category) AS INTEGER) AS rank
            FROM labelled GROUP BY 1, 2 QUALIFY rank <= 3""",
        "cluster_strategy": f"""{LABELLED} SELECT cluster,
            CASE WHEN avg(sold_qty) > 300 AND avg(waste_percentage) < 12
                THEN 'Staple champion with high turnover; keep reliable daily base stock.'
              WHEN avg(waste_percentage) >= 14
                THEN 'High spoilage risk; apply just-in-time preparation and reduce batch sizes.'
              WHEN avg(discount_percent) > 15 THEN 'Price-elastic item; coordinate kitchen prep '
                || 'with active promotion schedules.'
              ELSE 'Premium niche; maintain lower inventory and cold-storage preservation.' END
              AS operational_strategy,
            ['High-Volume Core Staples (Low Waste Ratio)',
             'High Waste-Risk Perishables (Spoilage Exposure)',
             'Promotional Surges (Elastic High-Volume)',
             'Premium Gourmet (Low Volume, High Margin)'][cluster + 1] AS name
            FROM labelled GROUP BY cluster""",
        "anomaly_diagnosis": f"""{JOINED} SELECT fact_id, week_number, month_name, item_name,
            category, cuisine, center_name, center_type, prepared_qty, sold_qty, waste_qty,
            ((pct_h + 5) // 10) / 10e0 AS waste_percentage,
            CAST(waste_cost AS DOUBLE) AS waste_cost,
            CASE WHEN emailer_for_promotion + homepage_featured > 0 AND pct_h > 1800 THEN
                'Failed Promotional Surge: Kitchen heavily over-prepared expecting spike that did '
                || 'not materialize.'
              WHEN category IN ('Fish', 'Seafood', 'Salad') AND pct_h > 2000 THEN
                'Perishability Expiry: Fresh shelf-life exceeded before inventory turnover could '
                || 'occur.'
              WHEN prepared_qty > 2000 AND sold_qty < 1200 THEN
                'Forecasting Buffer Overshoot: Multi-shift over-batching in mega distribution '
                || 'kitchen.'
              ELSE 'Abnormal Demand Collapse: Unanticipated local event or delivery disruption.'
              END AS root_cause_diagnosis
            FROM joined WHERE waste_percentage > (SELECT quantile_cont(waste_percentage, 0.98)
              FROM fact) ORDER BY joined.waste_cost DESC, fact_id LIMIT 15""",
    }


def _models() -> dict[str, str]:
    """What does not depend on how a model was fitted: sizes of the splits, shares, row sets."""
    parted = f"""{STAR}, tiers AS (SELECT demand_tier, count(*) AS n FROM fact GROUP BY 1),
        sizes AS (SELECT CAST(sum(n * 3 // 4) AS BIGINT) AS train, CAST(sum(n - n * 3 // 4) AS BIGINT) AS test
          FROM tiers), whole AS (SELECT count(*) AS n FROM fact)"""
    by_tier = f"""{parted} SELECT test AS test_records, least(30000, train) AS train_records,
        (SELECT CAST(max(n - n * 3 // 4) AS BIGINT) FROM tiers) AS majority_records,
        (SELECT CAST(sum((n - n * 3 // 4) * (n - n * 3 // 4)) // sum(n - n * 3 // 4) AS BIGINT) FROM tiers) AS guessed_records,
        true AS better_than_guessing FROM sizes"""
    plain = f"""{parted} SELECT n - n * 3 // 4 AS test_records, n * 3 // 4 AS train_records,
        true AS no_worse_than_the_mean{{more}} FROM whole"""
    return {
        "classifier_checks": by_tier,
        "tree_checks": by_tier,
        "regressor_checks": plain.format(more=""),
        "ridge_checks": plain.format(more=", true AS normal_equations_hold"),
        "importance_checks": """SELECT unnest(['classifier', 'regressor']) AS model,
            CAST(10 AS BIGINT) AS features, CAST(100 AS BIGINT) AS total_pct""",
        "score_tier_discounts": f"""{STAR} SELECT fact_id, round(greatest(0e0,
            CAST(base_price AS DOUBLE) - CAST(checkout_price AS DOUBLE)), 2) AS discount_applied FROM fact""",
        "forecast_buffers": f"""{STAR} SELECT fact_id, CASE WHEN category IN
            ('Salad', 'Fish', 'Seafood', 'Rice Bowl', 'Biryani') THEN 8e0 ELSE 12e0 END
            AS recommended_safety_buffer_pct, true AS covers_demand FROM fact""",
        "cluster_checks": f"""{STAR} SELECT count(*) AS records, CAST(4 AS BIGINT) AS clusters,
            true AS labels_have_the_inertia, true AS clusters_are_closer, true AS inertia_falls FROM fact""",
        "pca_checks": f"{STAR} SELECT count(*) AS records, count(DISTINCT fact_id) AS facts FROM fact",
        "anomaly_checks": f"""{STAR} SELECT count(*) AS records, true AS no_more_than_share,
            true AS flags_follow_sign FROM fact""",
    }


# the star after the feed was appended: its days are added to the calendar, its rows to the fact
APPENDED = STAR.replace("\ncal AS (", "\nloaded_cal AS (").replace("\nfact AS (", "\nloaded_fact AS (") + f""",
{FEED},
cal AS (
  SELECT * FROM loaded_cal UNION ALL BY NAME
  SELECT DISTINCT date_id, CAST(weekofyear(day) AS INTEGER) AS week_number, day AS calendar_date,
    monthname(day) AS month_name, CAST(month(day) AS INTEGER) AS month_number,
    'Q' || quarter(day) AS quarter, CAST(year(day) AS INTEGER) AS year,
    CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend_peak,
    CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) IN (3, 4, 5) THEN 'Spring'
         WHEN month(day) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
  FROM feed WHERE day NOT IN (SELECT calendar_date FROM loaded_cal)),
fact AS (
  SELECT * FROM loaded_fact UNION ALL BY NAME
  SELECT * EXCLUDE (day) REPLACE (coalesce(
    (SELECT max(c.date_id) FROM loaded_cal c WHERE c.calendar_date = day), date_id) AS date_id)
  FROM feed_fact)"""


def _after_append(known: dict[str, str]) -> dict[str, str]:
    return {f"{name}_after_append": known[name].replace(STAR, APPENDED, 1) for name in AFTER_APPEND}


AFTER_APPEND = ["olap_slice_cuisine", "olap_rollup_month", "olap_rollup_category", "olap_rollup_hierarchy",
                "olap_drilldown_category", "olap_pivot_cost", "kpi_summary", "chart_center_type", "chart_risk_tier",
                "period_bounds", "period_compare_monthly_by_year", "early_warning_daily"]
SAME = {"stream_feed_csv": "stream_ingest", "feed_files": "ingest_measures"}  # other ways to the same rows
ORACLE = {**_sources(), **_feeds(), **_olap(), **_reports(), **_periods(), **_mining(), **_models()}
ORACLE |= {name: ORACLE[other] for name, other in SAME.items()}
ORACLE |= _after_append(ORACLE)
