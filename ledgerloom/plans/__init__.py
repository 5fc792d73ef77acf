"""The warehouse jobs.

Each function takes source and target tables as DataFrames (schemas in FIXTURES.md) and returns
a DataFrame; its docstring carries the inventory ID.  `*_new` returns the rows to append,
`*_changed` the new state of the target, and `*_source` the query both share.
"""
