"""revue: product-review analytics and recommendation as Spark DataFrame plans.

Every public operator takes and returns DataFrames and stays lazy; the only
actions are model fits and the bounded iteration loop of the exact similarity
join. Sub-packages:

- ``sources``   review fixture derived from the driver tables, CSV / Parquet IO
- ``functions`` column expressions (parsers, dates, labels, score arithmetic)
- ``operators`` cleaning, statistics, features, similarity, ALS, recommendations
- ``plans``     the query catalogue used by ``__spark_entry__`` and its SQL oracle
"""

__version__ = "0.1.0"
