"""ledgerloom: a subscription-and-payments data warehouse built from Spark DataFrames.

The package reads operational tables and JSON record dumps, derives dimensions, facts,
history tables, aggregates, KPIs and finance reports, and gives the maintenance operators
that keep the target tables current.  Every job is a pure function of DataFrames and
parameters; clocks, id lists and account numbers are always parameters.
"""
