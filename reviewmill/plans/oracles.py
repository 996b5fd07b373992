"""The registered queries once more, as plain SQL over the supplied tables.

Written independently of the operators: string comparisons instead of lengths in the
deduplication, distinct counts and outer joins at every level instead of roll-ups.
"""

from __future__ import annotations

# The feeds, as described in FIXTURES.md.
_FEEDS = """
raw_reviews AS (
    SELECT CASE WHEN l_discount = 0.06 THEN 4.1::DOUBLE
                WHEN l_discount = 0.07 THEN 3.9::DOUBLE
                WHEN l_discount = 0.08 AND l_linenumber = 4 THEN 4.0005::DOUBLE
                WHEN l_discount = 0.05 THEN l_linenumber + 0.5::DOUBLE
                ELSE l_linenumber::DOUBLE END AS rating,
           CASE WHEN l_tax > 0 THEN 'order ' || l_orderkey END AS title,
           l_returnflag || l_linestatus AS text,
           'V' || l_partkey AS asin,
           CASE WHEN l_linenumber = 2 THEN NULL
                WHEN l_linenumber = 3 AND l_tax = 0.08 THEN '  '
                ELSE ' P' || l_partkey || ' ' END AS parent_asin,
           'U' || l_suppkey AS user_id,
           CASE WHEN l_discount = 0 THEN 0
                WHEN l_discount = 0.01 THEN NULL
                WHEN l_discount = 0.02 AND l_linenumber = 6 THEN -1
                WHEN l_discount = 0.02 AND l_linenumber = 7 THEN 253402300800000
                ELSE epoch_ms(l_shipdate) + (l_quantity * 10)::BIGINT END::BIGINT AS timestamp,
           CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN TRUE ELSE FALSE END
               AS verified_purchase,
           l_quantity::BIGINT - 10 AS helpful_vote
    FROM lineitem
    UNION ALL
    SELECT 5.0::DOUBLE, CASE WHEN l_tax > 0 THEN 'order ' || l_orderkey ELSE '' END,
           l_returnflag || l_linestatus, 'W' || l_partkey, 'P' || l_partkey, 'U' || l_suppkey,
           CASE WHEN l_discount = 0 THEN 0
                WHEN l_discount = 0.01 THEN NULL
                ELSE epoch_ms(l_shipdate) END::BIGINT,
           TRUE, 99::BIGINT
    FROM lineitem
    WHERE l_quantity = 50 AND l_linenumber = 1
    UNION ALL
    SELECT least(6.0::DOUBLE, 1 + floor(n_chars / 1000) * 0.5::DOUBLE), NULL, text, source,
           'D-' || lang, NULL, n_chars * 3600000, NULL, NULL
    FROM documents
),
raw_products AS (
    SELECT ' P' || p_partkey AS parent_asin,
           CASE WHEN p_size = 50 THEN NULL ELSE p_name END AS title,
           CASE p_size WHEN 7 THEN NULL WHEN 8 THEN '   ' ELSE ' ' || p_brand END AS store,
           p_type AS main_category,
           CASE p_size WHEN 9 THEN 'from 12.99' WHEN 10 THEN NULL WHEN 11 THEN '999999999.00'
                WHEN 12 THEN '-3.00' WHEN 24 THEN '12d' WHEN 26 THEN '1.0f' WHEN 28 THEN '1e3'
                WHEN 30 THEN ' 7.5 ' WHEN 33 THEN 'NaN' WHEN 35 THEN 'Infinity'
                WHEN 37 THEN '12.999' WHEN 39 THEN '' WHEN 41 THEN '12.99' || chr(10) WHEN 49 THEN '$1,225.00'
                ELSE '$' || (p_size * p_size * 0.5)::DECIMAL(10,2) END AS price,
           p_size / 10.0::DOUBLE AS average_rating,
           (p_size - 5)::BIGINT AS rating_number
    FROM part
    UNION ALL
    SELECT 'P' || p_partkey, 'dup', p_brand, p_type, '$1.00', 4.0::DOUBLE, 1::BIGINT
    FROM part
    WHERE p_size IN (3, 20)
    UNION ALL
    SELECT CASE WHEN s_nationkey = 0 THEN '   '
                WHEN s_acctbal >= 0 THEN 'S' || s_suppkey END,
           s_name, 'Own stock', NULL, (s_acctbal::DECIMAL(10,2))::VARCHAR, NULL,
           s_nationkey::BIGINT
    FROM supplier
)"""

_KEY = "trim(coalesce(parent_asin, asin), ' ')"
_SECOND = "CASE WHEN timestamp > 0 AND timestamp <= 253402300799999 THEN timestamp // 1000 END"
_TIME = f"(TIMESTAMP '1970-01-01' + to_seconds({_SECOND}))"
_TIME_TEXT = f"strftime({_TIME}, '%Y-%m-%d %H:%M:%S')"
_YEAR = f"coalesce(year({_TIME}), 0)::INTEGER"
_MONTH = f"coalesce(strftime({_TIME}, '%Y-%m'), 'unknown')"
_RATING = "CASE WHEN {0} BETWEEN 1 AND 5 THEN {0} END"
_COUNT = "CASE WHEN {0} >= 0 THEN {0} ELSE 0 END"
_ID = f"""sha256(concat_ws('||', {_KEY}, coalesce(user_id, ''), coalesce({_TIME_TEXT}, ''),
                 coalesce(title, ''), coalesce(text, '')))"""
_PRICE_TEXT = "replace(replace(trim(price, ' '), '$', ''), ',', '')"
_PRICE = rf"""CASE WHEN regexp_full_match({_PRICE_TEXT}, '[0-9]+(\.[0-9]{{1,2}})?')
                   THEN TRY_CAST({_PRICE_TEXT} AS DECIMAL(10,2)) END"""
_BRAND = "CASE WHEN length(trim(store, ' ')) > 0 THEN trim(store, ' ') ELSE 'Unknown' END"

_CURATED = f"""
keyed_reviews AS (
    SELECT {_ID} AS review_id, {_KEY} AS product_asin, asin AS variant_asin, user_id,
           {_RATING.format('rating')} AS rating, title AS review_title, text AS review_text,
           {_TIME_TEXT} AS review_timestamp, {_MONTH} AS review_month,
           coalesce(verified_purchase, FALSE) AS is_verified_purchase,
           {_COUNT.format('helpful_vote')} AS helpful_vote_count, {_YEAR} AS review_year
    FROM raw_reviews
    WHERE length({_KEY}) > 0
),
reviews AS (
    SELECT * FROM keyed_reviews
    QUALIFY row_number() OVER (
        PARTITION BY review_id
        ORDER BY is_verified_purchase DESC, helpful_vote_count DESC, rating DESC NULLS LAST,
                 variant_asin ASC NULLS LAST, product_asin ASC, user_id ASC NULLS LAST,
                 review_title ASC NULLS LAST, review_text ASC NULLS LAST) = 1
),
keyed_products AS (
    SELECT trim(parent_asin, ' ') AS product_asin, title AS product_title, {_BRAND} AS brand,
           main_category, {_PRICE} AS price,
           {_RATING.format('average_rating')} AS metadata_average_rating,
           {_COUNT.format('rating_number')} AS metadata_review_count
    FROM raw_products
    WHERE length(trim(parent_asin, ' ')) > 0
),
products AS (
    SELECT * FROM keyed_products
    QUALIFY row_number() OVER (
        PARTITION BY product_asin
        ORDER BY metadata_review_count DESC, metadata_average_rating DESC NULLS LAST,
                 price ASC NULLS LAST, brand ASC, product_title ASC NULLS LAST,
                 main_category ASC NULLS LAST) = 1
),
review_product AS (SELECT * FROM reviews LEFT JOIN products USING (product_asin))"""

# The mean rating to three places, rounded half up in whole numbers.
_MEAN = """((2 * sum((rating::DECIMAL(8,6) * 1000000)::BIGINT) + 1000 * count(rating))
            // (2000 * count(rating)))::DOUBLE / 1000"""

_SUMMARIES = f"""
product_stats AS (
    SELECT product_asin, count(*) AS review_count, count(rating) AS rated_review_count,
           {_MEAN} AS average_review_rating,
           count(*) FILTER (is_verified_purchase) AS verified_review_count,
           count(*) FILTER (NOT is_verified_purchase) AS non_verified_review_count,
           sum(helpful_vote_count)::BIGINT AS helpful_vote_count
    FROM review_product GROUP BY product_asin
),
product_summary AS (
    SELECT product_asin, product_title, coalesce(brand, 'Unknown') AS brand, main_category, price,
           metadata_average_rating, metadata_review_count,
           coalesce(review_count, 0) AS review_count,
           coalesce(rated_review_count, 0) AS rated_review_count,
           average_review_rating,
           coalesce(verified_review_count, 0) AS verified_review_count,
           coalesce(non_verified_review_count, 0) AS non_verified_review_count,
           coalesce(helpful_vote_count, 0) AS helpful_vote_count
    FROM products FULL JOIN product_stats USING (product_asin)
),
brand_products AS (
    SELECT brand, count(DISTINCT product_asin) AS product_count,
           round(avg(price), 2)::DOUBLE AS average_product_price
    FROM products GROUP BY brand
),
brand_reviews AS (
    SELECT coalesce(brand, 'Unknown') AS brand, count(*) AS review_count,
           count(rating) AS rated_review_count, {_MEAN} AS average_review_rating,
           count(*) FILTER (is_verified_purchase) AS verified_review_count
    FROM review_product GROUP BY 1
),
brand_summary AS (
    SELECT brand, coalesce(product_count, 0) AS product_count, average_product_price,
           coalesce(review_count, 0) AS review_count,
           coalesce(rated_review_count, 0) AS rated_review_count, average_review_rating,
           coalesce(verified_review_count, 0) AS verified_review_count
    FROM brand_products FULL JOIN brand_reviews USING (brand)
),
monthly_review_summary AS (
    SELECT review_year, review_month, count(*) AS review_count,
           count(rating) AS rated_review_count, round(sum(rating::DECIMAL(8,6)), 3)::DOUBLE AS rating_sum,
           {_MEAN} AS average_rating,
           count(*) FILTER (rating = 1) AS rating_1_count,
           count(*) FILTER (rating = 2) AS rating_2_count,
           count(*) FILTER (rating = 3) AS rating_3_count,
           count(*) FILTER (rating = 4) AS rating_4_count,
           count(*) FILTER (rating = 5) AS rating_5_count,
           count(*) FILTER (is_verified_purchase) AS verified_review_count,
           count(*) FILTER (NOT is_verified_purchase) AS non_verified_review_count,
           count(DISTINCT product_asin) AS reviewed_product_count
    FROM review_product GROUP BY review_year, review_month
)"""

_WITH = f"WITH {_FEEDS.strip()},{_CURATED},{_SUMMARIES}"

_STARS = " UNION ALL ".join(
    f"SELECT {star}::INTEGER AS rating, sum(rating_{star}_count)::BIGINT AS review_count "
    "FROM monthly_review_summary"
    for star in range(1, 6)
)

_BANDS = """
CASE WHEN price < 25 THEN '$0–24' WHEN price < 50 THEN '$25–49' WHEN price < 100 THEN '$50–99'
     WHEN price < 250 THEN '$100–249' WHEN price < 500 THEN '$250–499'
     WHEN price < 1000 THEN '$500–999' ELSE '$1,000+' END AS price_band,
CASE WHEN price < 25 THEN 1 WHEN price < 50 THEN 2 WHEN price < 100 THEN 3 WHEN price < 250 THEN 4
     WHEN price < 500 THEN 5 WHEN price < 1000 THEN 6 ELSE 7 END::INTEGER AS price_band_order"""

_ROLLING = """
SELECT strptime(review_month, '%Y-%m')::DATE AS day, review_count,
       avg(review_count) OVER (ORDER BY review_month ROWS 2 PRECEDING) AS rolling_reviews
FROM monthly_review_summary WHERE review_year <> 0"""

_TOP_PRODUCTS = """
SELECT product_asin, product_title, brand, review_count, average_review_rating
FROM product_summary WHERE review_count > 0 ORDER BY review_count DESC, product_asin LIMIT {}"""

_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
    for name in (
        "reviews",
        "products",
        "review_product",
        "product_summary",
        "brand_summary",
        "monthly_review_summary",
    )
)

_YEARS = "SELECT review_year, count(*) AS review_count FROM reviews GROUP BY review_year"

# Counts per distinct (input, output) pair of a rule: every row takes part in the comparison.
_SELECTS = {
    "scan_reviews_jsonl": "SELECT * FROM raw_reviews",
    "scan_products_jsonl": "SELECT * FROM raw_products",
    "resolve_product_key": f"""
        SELECT parent_asin, asin, {_KEY} AS product_asin, count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "drop_missing_key": f"""
        SELECT {_KEY} AS product_asin, count(*) AS n
        FROM raw_reviews WHERE length({_KEY}) > 0 GROUP BY ALL""",
    "valid_rating": f"""
        SELECT rating AS raw_rating, {_RATING.format('rating')} AS rating, count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "non_negative_count": f"""
        SELECT helpful_vote, {_COUNT.format('helpful_vote')} AS helpful_vote_count, count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "epoch_ms_to_timestamp": f"""
        SELECT timestamp AS epoch_ms, {_TIME_TEXT} AS review_timestamp, count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "default_false_flag": """
        SELECT verified_purchase, coalesce(verified_purchase, FALSE) AS is_verified_purchase,
               count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "year_month_sentinels": f"""
        SELECT {_YEAR} AS review_year, {_MONTH} AS review_month, count(*) AS n
        FROM raw_reviews GROUP BY ALL""",
    "stable_review_id": f"""
        SELECT {_ID} AS review_id, count(*) AS n
        FROM raw_reviews WHERE length({_KEY}) > 0 GROUP BY ALL""",
    "parse_price": f"""
        SELECT price AS price_text, ({_PRICE})::DOUBLE AS price, count(*) AS n
        FROM raw_products GROUP BY ALL""",
    "normalize_brand": f"""
        SELECT store, {_BRAND} AS brand, count(*) AS n FROM raw_products GROUP BY ALL""",
    "coerce_numeric": """
        SELECT CASE WHEN regexp_full_match(
                   price, ' *[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)? *'
               ) THEN TRY_CAST(trim(price) AS DOUBLE) END AS price,
               rating_number::DOUBLE AS rating_number,
               count(*) AS n
        FROM raw_products GROUP BY ALL""",
    "clean_reviews": "SELECT * FROM reviews",
    "clean_products": "SELECT * REPLACE (price::DOUBLE AS price) FROM products",
    "dedup_reviews": """
        SELECT review_id, variant_asin, rating, is_verified_purchase, helpful_vote_count
        FROM reviews""",
    "dedup_products": """
        SELECT product_asin, product_title, price::DOUBLE AS price, metadata_review_count
        FROM products""",
    "enrich_reviews": "SELECT * REPLACE (price::DOUBLE AS price) FROM review_product",
    "product_review_stats": "SELECT * FROM product_stats",
    "product_summary": "SELECT * REPLACE (price::DOUBLE AS price) FROM product_summary",
    "brand_product_stats": "SELECT * FROM brand_products",
    "brand_review_stats": "SELECT * FROM brand_reviews",
    "brand_summary": "SELECT * FROM brand_summary",
    "monthly_summary": "SELECT * FROM monthly_review_summary",
    "sink_parquet_roundtrip": "SELECT * REPLACE (price::DOUBLE AS price) FROM products",
    "sink_partitioned_roundtrip": "SELECT * FROM reviews",
    "batch_row_counts": _ROW_COUNTS,
    "catalog_register": _ROW_COUNTS,
    "use_database": """
        SELECT review_year, count(*) AS months, sum(review_count)::BIGINT AS review_count
        FROM monthly_review_summary WHERE review_year <> 0 GROUP BY review_year""",
    "utc_session": """
        SELECT CASE WHEN review_month <> 'unknown' THEN review_month END AS review_month,
               count(*) AS review_count
        FROM reviews GROUP BY ALL""",
    "detail_unordered": """
        SELECT '1998' AS review_year, least(100, count(*)) AS n
        FROM review_product WHERE review_year = 1998""",
    "batch_product_summary": "SELECT * REPLACE (price::DOUBLE AS price) FROM product_summary",
    "batch_brand_summary": "SELECT * FROM brand_summary",
    "batch_monthly_summary": "SELECT * FROM monthly_review_summary",
    "batch_review_product": "SELECT * REPLACE (price::DOUBLE AS price) FROM review_product",
    "published_tables": f"SELECT *, row_count AS stated_rows FROM ({_ROW_COUNTS})",
    "quarantined_lines": """
        SELECT 'reviews' AS feed, 'unreadable' AS reason, '{"rating": 5.0, "parent_asin": "S' || s_suppkey AS line
        FROM supplier
        UNION ALL
        SELECT 'reviews', 'wrong types', '{"rating": "5.0", "parent_asin": "S' || s_suppkey
               || '", "asin": 7, "text": "typed", "user_id": "U' || s_suppkey
               || '", "helpful_vote": "3", "verified_purchase": "true", "timestamp": 1.7e12, "more": {"a": [1]}}'
        FROM supplier""",
    "check_tables_present": f"SELECT *, TRUE AS is_present FROM ({_ROW_COUNTS})",
    "overall_metrics": """
        SELECT sum(review_count)::BIGINT AS total_reviews,
               sum(rated_review_count)::BIGINT AS rated_reviews,
               ((2 * sum((rating_sum::DECIMAL(18,3) * 1000)::BIGINT)
                 + 10 * sum(rated_review_count)) // (20 * sum(rated_review_count)))::DOUBLE / 100
                   AS average_rating
        FROM monthly_review_summary""",
    "total_products": "SELECT count(*) AS total_products FROM products",
    "rating_distribution": _STARS,
    "rating_share": f"""
        SELECT rating, review_count,
               coalesce(review_count / nullif(sum(review_count) OVER (), 0), 0)::DOUBLE
                   AS review_share
        FROM ({_STARS})""",
    "verification_split": """
        SELECT 'Verified' AS purchase_type, sum(verified_review_count)::BIGINT AS review_count
        FROM monthly_review_summary
        UNION ALL
        SELECT 'Non-verified', sum(non_verified_review_count)::BIGINT
        FROM monthly_review_summary""",
    "top_products": _TOP_PRODUCTS.format(20),
    "product_label": f"""
        SELECT *, left(coalesce(nullif(product_title, ''), 'Unknown product'), 48) || ' · '
                  || right(product_asin, 6) AS product_label
        FROM ({_TOP_PRODUCTS.format(10)})""",
    "top_brands": """
        SELECT brand, product_count, review_count, average_review_rating, average_product_price
        FROM brand_summary WHERE review_count >= 10 ORDER BY review_count DESC, brand LIMIT 30""",
    "brand_performance": """
        SELECT brand, product_count, review_count, average_review_rating
        FROM brand_summary
        WHERE review_count >= 10 AND average_review_rating IS NOT NULL AND brand <> 'Unknown'
        ORDER BY review_count DESC, brand LIMIT 12""",
    "monthly_trend": """
        SELECT review_month, review_count, average_rating, reviewed_product_count
        FROM monthly_review_summary WHERE review_year <> 0""",
    "monthly_rolling": f"""
        SELECT strftime(day, '%Y-%m-%d') AS month, review_count, rolling_reviews
        FROM ({_ROLLING})""",
    "monthly_trend_long": f"""
        SELECT strftime(day, '%Y-%m-%d') AS month, 'Monthly reviews' AS series,
               review_count::DOUBLE AS reviews
        FROM ({_ROLLING})
        UNION ALL
        SELECT strftime(day, '%Y-%m-%d'), '3-month average', rolling_reviews FROM ({_ROLLING})""",
    "price_vs_rating": """
        SELECT product_asin, product_title, brand, price::DOUBLE AS price, average_review_rating,
               review_count
        FROM product_summary
        WHERE price IS NOT NULL AND average_review_rating IS NOT NULL AND review_count >= 5
        ORDER BY review_count DESC, product_asin LIMIT 1000""",
    "price_bands": f"""
        SELECT price_band, price_band_order, count(*) AS product_count,
               sum(review_count)::BIGINT AS review_count,
               sum(average_review_rating::DECIMAL(10,3))::DOUBLE / count(*) AS average_rating
        FROM (SELECT *, {_BANDS} FROM product_summary
              WHERE price >= 0 AND average_review_rating IS NOT NULL AND review_count >= 5)
        GROUP BY price_band, price_band_order""",
    "top_by_metadata": """
        SELECT product_asin, product_title, brand, metadata_review_count, metadata_average_rating
        FROM product_summary ORDER BY metadata_review_count DESC NULLS LAST, product_asin
        LIMIT 20""",
    "detail_by_year": """
        SELECT review_month, rating, is_verified_purchase, product_title, brand
        FROM review_product WHERE review_year = 1998 ORDER BY review_id LIMIT 100""",
    "check_row_counts": """
        SELECT 'reviews' AS table_name, count(*) AS row_count FROM reviews
        UNION ALL SELECT 'products', count(*) FROM products
        UNION ALL SELECT 'review_product', count(*) FROM review_product""",
    "check_missing_keys": """
        SELECT 'reviews' AS table_name, count(*) AS missing_product_ids FROM reviews
        WHERE product_asin IS NULL OR trim(product_asin, ' ') = ''
        UNION ALL
        SELECT 'products', count(*) FROM products
        WHERE product_asin IS NULL OR trim(product_asin, ' ') = ''""",
    "check_duplicates": """
        SELECT 'reviews' AS table_name,
               count(*) - count(DISTINCT review_id) AS duplicate_count FROM reviews
        UNION ALL
        SELECT 'products', count(*) - count(DISTINCT product_asin) FROM products""",
    "check_domains": """
        SELECT 'invalid_ratings' AS measure,
               count(*) FILTER (rating < 1 OR rating > 5) AS invalid FROM reviews
        UNION ALL
        SELECT 'invalid_helpful_votes', count(*) FILTER (helpful_vote_count < 0) FROM reviews
        UNION ALL
        SELECT 'invalid_prices', count(*) FILTER (price < 0) FROM products
        UNION ALL
        SELECT 'invalid_review_counts', count(*) FILTER (metadata_review_count < 0)
        FROM products""",
    "check_unmatched": """
        SELECT count(*) AS total_reviews,
               count(*) FILTER (product_title IS NULL) AS unmatched_reviews,
               round(100.0::DOUBLE * count(*) FILTER (product_title IS NULL) / count(*), 2)
                   AS unmatched_percent
        FROM review_product""",
    "check_year_partitions": _YEARS,
    "check_reconciliation": """
        SELECT (SELECT count(*) FROM reviews) AS curated_reviews,
               (SELECT sum(review_count) FROM monthly_review_summary)::BIGINT
                   AS monthly_summary_reviews""",
    "quality_report": f"""
        WITH facts(check_name, observed, expected) AS (
            SELECT 'rows_reviews', count(*), NULL FROM reviews
            UNION ALL SELECT 'rows_products', count(*), NULL FROM products
            UNION ALL SELECT 'rows_review_product', count(*), NULL FROM review_product
            UNION ALL SELECT 'missing_keys_reviews',
                count(*) FILTER (product_asin IS NULL OR trim(product_asin, ' ') = ''), 0
                FROM reviews
            UNION ALL SELECT 'missing_keys_products',
                count(*) FILTER (product_asin IS NULL OR trim(product_asin, ' ') = ''), 0
                FROM products
            UNION ALL SELECT 'duplicate_review_ids', count(*) - count(DISTINCT review_id), 0
                FROM reviews
            UNION ALL SELECT 'duplicate_product_ids', count(*) - count(DISTINCT product_asin), 0
                FROM products
            UNION ALL SELECT 'invalid_ratings', count(*) FILTER (rating < 1 OR rating > 5), 0
                FROM reviews
            UNION ALL SELECT 'invalid_helpful_votes', count(*) FILTER (helpful_vote_count < 0), 0
                FROM reviews
            UNION ALL SELECT 'invalid_prices', count(*) FILTER (price < 0), 0 FROM products
            UNION ALL SELECT 'invalid_metadata_counts',
                count(*) FILTER (metadata_review_count < 0), 0 FROM products
            UNION ALL SELECT 'unmatched_reviews', count(*) FILTER (product_title IS NULL), NULL
                FROM review_product
            UNION ALL SELECT 'unmatched_percent',
                round(100.0::DOUBLE * count(*) FILTER (product_title IS NULL) / count(*), 2), NULL
                FROM review_product
            UNION ALL SELECT 'rows_in_year_' || review_year, review_count, NULL FROM ({_YEARS})
            UNION ALL SELECT 'monthly_total_difference',
                (SELECT sum(review_count) FROM monthly_review_summary)
                - (SELECT count(*) FROM reviews), 0
        )
        SELECT check_name, observed::DOUBLE AS observed, expected::DOUBLE AS expected,
               observed = expected AS passed
        FROM facts""",
}


# What the batch job's review feed holds besides: the readable part of lines with wrong types.
_ODD_LINES = """
    FROM documents
    UNION ALL
    SELECT NULL, NULL, 'typed', '7', 'S' || s_suppkey, 'U' || s_suppkey, NULL, NULL, NULL
    FROM supplier
),
raw_products"""

#: Queries over the tables of the batch job itself.
_OF_JOB = (
    "batch_product_summary",
    "batch_brand_summary",
    "batch_monthly_summary",
    "batch_review_product",
    "published_tables",
    "audit_report",
)


#: Queries that get by another way what another one gets.
_SAME = {
    "audit_report": "quality_report",
    "copartitioned_enrich": "enrich_reviews",
    "copartitioned_product_stats": "product_review_stats",
    "copartitioned_product_summary": "product_summary",
    "upkeep_product_summary": "product_summary",
    "upkeep_brand_summary": "brand_summary",
    "upkeep_monthly_summary": "monthly_summary",
}


def statements() -> dict[str, str]:
    """One complete statement per registered query."""
    job = _WITH.replace("\n    FROM documents\n),\nraw_products", _ODD_LINES)
    made = {}
    for name, select in (_SELECTS | {also: _SELECTS[name] for also, name in _SAME.items()}).items():
        before = job if name in _OF_JOB else _WITH
        select = select.strip()
        made[name] = f"{before}, {select[5:]}" if select.startswith("WITH ") else f"{before} {select}"
    return made
