"""The word lists, rates, thresholds and message texts that define the results."""

# --- Fixed values: preparation rate by category (share prepared per unit sold) -----------------
DEFAULT_PREP_RATE = 1.12
PREP_RATES = {
    "Fish": 1.21,
    "Seafood": 1.19,
    "Salad": 1.18,
    "Biryani": 1.15,
    "Rice Bowl": 1.14,
    "Soup": 1.14,
    "Pasta": 1.12,
    "Sandwich": 1.12,
    "Pizza": 1.11,
    "Desert": 1.10,
    "Starters": 1.11,
    "Other Snacks": 1.09,
    "Extras": 1.08,
    "Beverages": 1.07,
}
PROMO_BOOST = 0.035
PREP_NOISE_STD = 0.025
PREP_RATIO_MIN, PREP_RATIO_MAX = 1.03, 1.34
COST_SHARE = "0.42"

# --- Fixed values: food group and spoilage sensitivity by category -----------------------------
DEFAULT_FOOD_GROUP = ("Mains", "Moderate")
FOOD_GROUPS = {
    "Beverages": ("Beverages", "Low"),
    "Extras": ("Starters & Sides", "Low"),
    "Soup": ("Starters & Sides", "Moderate"),
    "Other Snacks": ("Starters & Sides", "Moderate"),
    "Salad": ("Starters & Sides", "High"),
    "Rice Bowl": ("Mains", "High"),
    "Starters": ("Starters & Sides", "Moderate"),
    "Sandwich": ("Mains", "Moderate"),
    "Pasta": ("Mains", "Moderate"),
    "Desert": ("Desserts", "Moderate"),
    "Biryani": ("Mains", "High"),
    "Pizza": ("Mains", "Moderate"),
    "Fish": ("Mains", "High"),
    "Seafood": ("Mains", "High"),
}

# --- Fixed values: shelf life rules, (categories, perishability, days, storage) -----------------
SHELF_LIFE_RULES = [
    (["Salad", "Fish", "Seafood"], "High", 1, "Cold Storage (0-4°C)"),
    (["Rice Bowl", "Biryani", "Soup"], "High", 2, "Chilled Prep (2-5°C)"),
    (["Sandwich", "Pasta", "Pizza", "Starters"], "Medium", 3, "Chilled Prep (2-5°C)"),
    (["Desert"], "Medium", 5, "Chilled Dessert Cooler"),
]
DEFAULT_SHELF_LIFE = ("Low", 30, "Ambient Storage")

# --- Fixed values: capacity tier by operating area, highest floor first -------------------------
CAPACITY_TIERS = [(5.0, "Mega Distribution Hub"), (3.5, "Urban Central Kitchen")]
DEFAULT_CAPACITY_TIER = "Express Fulfillment Depot"

# --- Fixed values: menu names by meal id --------------------------------------------------------
MEAL_NAMES = {
    1885: "Thai Jasmine Iced Tea", 1993: "Lemongrass Cooler", 2539: "Thai Coconut Smoothie",
    1248: "Masala Chai Deluxe", 2631: "Mango Lassi Fusion", 1311: "Cold Brew Iced Coffee",
    1062: "Spiced Mint Lemonade", 1778: "Italian Espresso Tonic", 1803: "Sparkling Ginger Ale",
    1198: "Berry Infusion Soda", 2707: "Classic Veg Hakka Noodles", 1847: "Thai Green Curry Bowl",
    1438: "Steamed Jasmine Rice", 2492: "Pad Thai Wok Rice", 2764: "Paneer Tikka Rice Bowl",
    2581: "Hyderabadi Dum Biryani", 1962: "Kashmiri Mutton Biryani", 2444: "Lucknowi Veg Biryani",
    2867: "Creamy Chicken Alfredo Pasta", 1727: "Penne Arrabiata Bowl", 1902: "Pesto Genovese Pasta",
    1247: "Smoked Chicken Quesadilla", 2306: "Grilled Paneer Sandwich", 2126: "Herb Roast Chicken Sub",
    2825: "Artisan Woodfired Pizza", 2139: "Margherita Basil Pizza", 2640: "Spicy Pepperoni Pizza",
    2577: "Crispy Spring Rolls", 1878: "Veg Manchurian Starters", 2104: "Chicken Satay Skewers",
    2494: "Garlic Butter Naan Basket", 1558: "Gourmet Salad Niçoise", 1977: "Greek Feta Olive Salad",
    2123: "Farm Fresh Green Bowl", 2826: "Hot & Sour Veg Soup", 2664: "Cream of Wild Mushroom",
    2569: "Tom Yum Prawn Soup", 1230: "Szechuan Spiced Fish", 1207: "Golden Fried Calamari",
    1216: "Chili Garlic Grilled Fish", 1728: "Butter Glazed Tiger Prawns", 2128: "Coastal Crab Delight",
    1571: "Dark Chocolate Fondant", 2956: "Tiramisu Espresso Cup", 1525: "Warm Apple Cinnamon Tart",
    2704: "Gulab Jamun Trio", 2490: "New York Berry Cheesecake", 1445: "Choco Chip Brownie Slice",
    2447: "Assorted Breadsticks", 2769: "Spiced Corn & Pepper Dip", 1543: "Crispy Herb Wedges",
}

# --- Fixed values: tier thresholds --------------------------------------------------------------
WASTE_HIGH_ABOVE, WASTE_MEDIUM_FROM = 16.0, 8.0
DEMAND_HIGH_ABOVE, DEMAND_MEDIUM_FROM = 350, 100
TIER_LABELS = ["LOW", "MEDIUM", "HIGH"]

# --- Fixed values: scorecard ratings ------------------------------------------------------------
RATING_URGENT_ABOVE, RATING_ATTENTION_ABOVE = 14.0, 10.0
RATINGS = ("URGENT INTERVENTION", "ATTENTION NEEDED", "OPTIMAL EFFICIENCY")
SAVINGS_SHARE = 0.25

# --- Fixed values: incremental feeds ------------------------------------------------------------
# texts of a CSV field that mean a missing value
MISSING_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                  "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# accepted column names by meaning, first match wins
FEED_SYNONYMS = {
    "date": ["date", "calendar_date", "order_date", "day", "timestamp"],
    "week": ["week", "week_number", "week_no"],
    "sold": ["sold_qty", "num_orders", "sold", "orders", "sales"],
    "prepared": ["prepared_qty", "prepared", "quantity_prepared", "production_qty"],
    "waste": ["waste_qty", "unsold", "waste", "spoilage", "food_wasted"],
    "price": ["checkout_price", "price", "selling_price"],
    "base": ["base_price", "list_price", "cost"],
    "meal": ["meal_id", "dish_id", "food_id"],
    "center": ["center_id", "hub_id", "store_id", "kitchen_id"],
}
FEED_DEFAULT_PRICE = "285.50"
FEED_DEFAULT_BASE = "310.00"
FEED_SOLD_FROM, FEED_SOLD_BELOW = 80, 320
FEED_NOISE_STD = 0.02
FEED_RATIO_MIN, FEED_RATIO_MAX = 1.05, 1.30
FEED_FIRST_RECORD_ID = 1_000_000
FEED_DEFAULT_LAST_WEEK = 26

# --- Fixed values: the base calendar ------------------------------------------------------------
CALENDAR_START, CALENDAR_WEEKS = "2024-01-01", 26
MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]

# --- Fixed values: early warning levels and texts -----------------------------------------------
WARNING_FROM, CRITICAL_FROM = 5.0, 15.0
WARNING_BADGES = {"NORMAL": "🟢 Normal", "WARNING": "🟡 Warning", "CRITICAL": "🔴 Critical"}
MSG_BASELINE = ("Baseline period selected. Awaiting prior historical records "
                "for automated delta detection.")
MSG_NO_CHANGE = "Food waste is within normal operational thresholds."
MSG_CRITICAL = ("Food waste has increased significantly compared with the previous period. "
                "Immediate review is recommended.")
MSG_WARNING = ("Food waste has moderately increased compared with the previous period. "
               "Preventive buffer review advised.")
MSG_CONTROLLED = "Food waste is well controlled (%s) and within acceptable operational thresholds."
DETAIL_BASELINE = ("No prior records exist for this exact timeframe. "
                   "Operational measures recorded as baseline.")
DETAIL_NO_CHANGE = "Food waste metrics align with baseline operating expectations."
DETAIL_CRITICAL = ("Significant waste surge detected: Waste increased by %s (%s units) versus the "
                   "prior period. Immediate kitchen prep calibration and inventory safety buffer "
                   "audit strongly recommended.")
DETAIL_WARNING = ("Elevated waste detected: Food waste increased by %s (%s units). "
                  "Monitor recipe prep volumes and discount promotions.")
DETAIL_CONTROLLED = ("Food waste remains stable compared to previous period (%s). "
                     "Preparation and customer demand are well synchronized.")
BASELINE_DISPLAY = "N/A (Baseline)"

# --- Fixed values: scoring defaults and texts ---------------------------------------------------
SCENARIO_DEFAULTS = {
    "checkout_price": 250.0,
    "base_price": 300.0,
    "emailer_for_promotion": 0,
    "homepage_featured": 0,
    "op_area": 4.0,
    "category": "Rice Bowl",
    "cuisine": "Indian",
    "center_type": "TYPE_A",
}
TIER_ADVICE = {
    "LOW": "Stock conservative buffer of 5-8% to prevent over-preparation spoilage.",
    "MEDIUM": "Maintain standard 10-12% inventory buffer; monitor midday depletion.",
    "HIGH": "Prepare in staggered batches with 15% safety stock to meet surges without "
            "end-of-day waste.",
}
PREP_DEMAND_FLOOR = 10
PERISHABLE_BUFFER, STANDARD_BUFFER = "0.08", "0.12"
PERISHABLE_CATEGORIES = ["Salad", "Fish", "Seafood", "Rice Bowl", "Biryani"]
PREP_NOTE = ("Preparing %s units maintains a %s%% buffer to absorb peak orders while capping "
             "projected waste to under %s%%.")

# --- Fixed values: cluster archetypes (largest mean sold first) and strategies ------------------
ARCHETYPES = [
    "High-Volume Core Staples (Low Waste Ratio)",
    "High Waste-Risk Perishables (Spoilage Exposure)",
    "Promotional Surges (Elastic High-Volume)",
    "Premium Gourmet (Low Volume, High Margin)",
]
STRATEGY_STAPLE = "Staple champion with high turnover; keep reliable daily base stock."
STRATEGY_SPOILAGE = "High spoilage risk; apply just-in-time preparation and reduce batch sizes."
STRATEGY_ELASTIC = ("Price-elastic item; coordinate kitchen prep with active promotion schedules.")
STRATEGY_NICHE = "Premium niche; maintain lower inventory and cold-storage preservation."

# --- Fixed values: association rules ------------------------------------------------------------
RULE_MIN_SUPPORT, RULE_MIN_CONFIDENCE, RULE_MIN_LIFT = 0.08, 0.55, 1.2
CERTAIN_CONVICTION = 99.0
RULE_ADVICE = ("When customers order '%s', %s%% simultaneously purchase '%s'. Pre-pack in dynamic "
               "combo bundles to synchronize shelf life and eliminate unsold side-item spoilage.")

# --- Fixed values: anomaly diagnosis ------------------------------------------------------------
FRESH_CATEGORIES = ["Fish", "Seafood", "Salad"]
CAUSE_PROMO = ("Failed Promotional Surge: Kitchen heavily over-prepared expecting spike that did "
               "not materialize.")
CAUSE_EXPIRY = ("Perishability Expiry: Fresh shelf-life exceeded before inventory turnover could "
                "occur.")
CAUSE_BUFFER = ("Forecasting Buffer Overshoot: Multi-shift over-batching in mega distribution "
                "kitchen.")
CAUSE_COLLAPSE = ("Abnormal Demand Collapse: Unanticipated local event or delivery disruption.")

# --- Fixed values: insight cards ----------------------------------------------------------------
INSIGHT_CARDS = {
    "high_waste": {
        "id": "insight_high_waste",
        "category": "High-Waste Food Items",
        "badge": "Critical Priority",
        "title": "Excess Spoilage in Fresh %s",
        "metric_label": "Peak Waste Rate",
        "metric_value": "%.1f%%",
        "summary": "'%s' leads all catalog items in waste ratio. A total of %,d units were "
                   "discarded across recorded fulfillment cycles, resulting in $%,.2f in "
                   "spoilage loss.",
        "action": "Reduce morning preparation batch sizes by 15% and switch to just-in-time "
                  "preparation in the second half of shifts.",
    },
    "peak": {
        "id": "insight_peak_demand",
        "category": "High-Demand Periods",
        "badge": "Operational Surge",
        "title": "Peak Demand Velocity in %s",
        "metric_label": "Period Orders",
        "metric_value": "%,d units",
        "summary": "%s observed highest sales volume with an average waste rate of %.1f%%. High "
                   "operational turnover in this period allowed faster ingredient depletion, "
                   "reducing end-of-day food decay.",
        "action": "Use peak-demand periods to cycle slower-moving inventory bundles with "
                  "promotions.",
    },
    "rule": {
        "id": "insight_association_rule",
        "category": "Strong Food Associations",
        "badge": "Cross-Selling & Prep Sync",
        "title": "Synergistic Demand: %s + %s",
        "metric_label": "Rule Confidence & Lift",
        "metric_value": "%.1f%% Conf / %.2fx Lift",
        "summary": "Apriori rule mining uncovered that customers buying '%s' have a %.1f%% "
                   "probability of adding '%s'. Currently, kitchen preparation batches for these "
                   "two items are decoupled, leading to leftover side items.",
        "action": "Synchronize kitchen batch prep so companion sides are prepared strictly in "
                  "matching 1:1 or 1:2 companion multiples.",
    },
    "anomaly": {
        "id": "insight_anomaly_detection",
        "category": "Unusual Waste Patterns",
        "badge": "Outlier Event",
        "title": "Severe Spoilage Incident at %s",
        "metric_label": "Monetary Spoilage",
        "metric_value": "$%,.2f",
        "summary": "Isolation Forest flagged fact #%d (%s in week %d). Prepared %,d units but "
                   "sold only %,d, causing %.1f%% waste (%s).",
        "action": "Audit kitchen ordering thresholds when launching homepage features; impose a "
                  "20% cap on unconfirmed promo buffers.",
    },
    "cluster": {
        "id": "insight_clustering",
        "category": "Menu Portfolio Clustering",
        "badge": "Portfolio Optimization",
        "title": "K-Means Segment: %s",
        "metric_label": "Catalog Share",
        "metric_value": "%.1f%% of Menu",
        "summary": "Clustering isolated a segment of %,d menu entries characterized by high "
                   "waste percentage (%.2f%%) despite moderate price. Predominantly found in %s.",
        "action": None,  # the cluster's own strategy
    },
}
