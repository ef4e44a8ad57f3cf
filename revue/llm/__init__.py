"""Training-data operators: dedup, sharding, mixing, filters, language, toxicity, tokens.

Nothing outside this package imports it (``__spark_entry__`` adds its queries when
it is there). Each module holds one operator with a general interface; ``queries``
holds the thin registered queries and their SQL.
"""
