"""Fixed values.

Parameters and patterns whose values must equal the original workload's for the
results to match. Every operator takes them as overridable defaults.
"""

# Raw-field parsing patterns.
PRICE_STRIP = r"[^0-9.]"          # characters removed from a raw price
NUMERIC = r"^[0-9.]+$"            # a cleaned price / a plain rating must match this
VOTES = r"^[0-9]+/[0-9]+$"        # helpfulness "helpful/total"
PRICE_MISSING = ("", "unknown")   # raw prices treated as missing
TITLE_DROP = r"[^a-zA-Z0-9\s]"    # characters removed from a lower-cased title

# Cleaning.
MIN_USER_REVIEWS = 5
MIN_PRODUCT_REVIEWS = 10
MEDIAN_QUANTILE = 0.5

# Statistics and dashboard lists.
POPULAR_MIN_REVIEWS = 10
TOP_K = 10
SAMPLE_FRACTION = 0.5
SEED = 42
HISTOGRAM_BINS = {"price": 50, "helpful_votes": 30, "residual": 50}

# Title features and similarity.
MIN_DF = 2
MIN_SIMILARITY = 0.1
SIMILAR_K = 10
LSH_BUCKET_LENGTH = 2.0
LSH_HASH_TABLES = 3
LSH_MAX_DISTANCE = 2.0

# Recommendation scores.
NEUTRAL_RATING = 3.0              # preference weight = (rating - 3) / 2
RATING_HALF_RANGE = 2.0
FRACTION_SCALE = 5.0              # the served model reads 'a/b' as a share of five stars
ALS_WEIGHT = 0.7
CONTENT_WEIGHT = 0.3
