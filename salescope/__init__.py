"""salescope: retail sales analytics and forecasting as Spark DataFrame jobs.

Layout
------
sources/    readers for order files, the six panel tables and the driver
            parquet tables; sinks for metrics, summaries and model bundles
functions/  column expressions (dates, calendar, buckets, clipping, rounding)
operators/  DataFrame -> DataFrame operators: quality checks, aggregates,
            exact quantiles, joins, windows, chart tables, encoders,
            models and metrics
plans/      compositions: order-revenue modelling, store-sales forecast,
            batch scoring, and the query catalog used by the driver
streaming/  the stateless scoring plan on a streaming source
"""

__all__ = ["session"]
