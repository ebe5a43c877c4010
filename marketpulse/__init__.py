"""marketpulse: social posts joined with hourly market bars, on Spark.

Layers: ``sources`` (landed pages, company dimension, test-table adapters),
``functions`` (column expressions), ``operators`` (tagging, bucket join,
aggregates, page cap, keyword match, upsert), ``plans`` (bronze / silver /
gold / snapshot tables), ``streaming`` (staged posts into bronze).
"""

__version__ = "0.1.0"
