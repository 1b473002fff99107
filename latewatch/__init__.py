"""latewatch — public-transport punctuality analytics as Spark DataFrame jobs.

Raw real-time trip-update captures, timetable tables and hourly weather are
landed as DataFrames, reduced to the newest observation of every stop event,
enriched into one row per stop event (the *silver* table) and summarised into
network, line, hour, day, station and weather aggregates, ranked lists,
dashboard widget data and a late-arrival classifier.

Sub-packages:
    sources    scans, flatteners and sinks (bronze layer)
    functions  column expressions shared by the operators
    operators  relational building blocks (latest-per-key, enrichment, aggregates, model)
    plans      fixture adapters, the query catalogue and the medallion refresh
    streaming  incremental ingest and incremental latest-per-key
"""

__version__ = "0.1.0"
