"""quantlake: a Spark-native market-data lakehouse.

Daily OHLCV bars flow raw -> staging -> curated (with technical indicators),
live ticks are decoded by Structured Streaming into a partitioned table, and
views / dashboard measures are plain DataFrame functions over those tables.

Layout:
    sources/    lake zones, catalog tables, Kafka records, wide history, test adapters
    operators/  cleaning, de-duplication, indicator windows
    functions/  column expressions (percent change, RSI label, market status, ...)
    plans/      views, measures, the batch job, the query registry and SQL oracles
    streaming/  tick decoding and the checkpointed file sink
"""

__version__ = "0.1.0"
