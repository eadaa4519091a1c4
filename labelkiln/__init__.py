"""labelkiln: multilabel report analytics as Spark DataFrame / SQL / ML jobs.

Layout
------
sources/    readers and writers (delimited text, id lists, parquet sinks)
functions/  Column-level helpers (string, array, label rules, n-grams)
operators/  DataFrame -> DataFrame operators (rollup, joins, profiling,
            splits, TF-IDF, chi-square, thresholds, metrics, ranking,
            models, explanations)
plans/      views that bind the operators to concrete tables, and the
            query catalog (one Spark query + one oracle SQL per operator)
streaming/  Structured Streaming variants
rules/      versioned label / drop dictionaries (data, not code)
"""

__version__ = "0.1.0"
