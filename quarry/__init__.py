"""quarry: an analytics engine made of Spark DataFrames, SQL and Catalyst.

operators/  aggregates, table engines, dictionaries, joins, windows
functions/  the scalar dialect as Column expressions
sources/    readers, type grammar, catalog, settings, sinks
plans/      registered queries with their SQL twins, and plan reports
streaming/  Structured Streaming helpers
"""
