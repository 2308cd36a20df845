"""tickstat: order-book liquidity analytics on Spark.

Plain DataFrame -> DataFrame functions over a half-open date window:
``operators`` (ticks, markets, reports, quality, sinks, tiles), ``sources``
(raw scan, slots, file audit, landed metadata), ``functions`` (column
helpers), ``plans`` (the daily job, the query registry and its SQL oracle)
and ``streaming`` (incremental load of landed files).
"""

__version__ = "0.1.0"
