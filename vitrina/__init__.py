"""vitrina: batch data marts on Spark.

Staging tables and spreadsheet-shaped rows go in as DataFrames; monthly
payment, advertising-budget and weekly-profit marts come out, plus the jobs
that move data around them (full reloads, slice replacement, export).

Layout:
    sources/    readers: driver tables, fixture views, tabular files, tables
    functions/  column expressions (text to number, name tokens, weeks, ratios)
    operators/  DataFrame -> DataFrame building blocks (joins, aggs, sinks)
    plans/      the marts and jobs composed from the operators
    streaming/  incremental feed of the month load (foreachBatch)
"""

__version__ = "0.1.0"
