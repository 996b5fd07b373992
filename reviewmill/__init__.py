"""reviewmill: a PySpark-native analytics engine for product reviews.

Two JSON Lines feeds (reviews and product metadata) become three curated tables and three
pre-aggregated ones; reports and data-quality checks are DataFrame functions over those tables.
"""
