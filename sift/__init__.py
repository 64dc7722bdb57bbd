"""sift: ranked text search and comment sentiment analytics on Spark.

Subpackages:
    sources    -- schemas, file readers / writers, bindings to the given tables
    functions  -- Column expressions (text cleaning, n-grams, flags, paging)
    operators  -- DataFrame -> DataFrame operators (index, search, ranking,
                  sentiment shares, reports, data quality, sampling, ML)
    plans      -- contract queries and their DuckDB SQL
    streaming  -- incremental form of the share reports
"""

__version__ = "0.1.0"
