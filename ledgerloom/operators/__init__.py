"""Relational operators on DataFrames: table maintenance, hierarchy walk, calendar, run log."""
