"""Registered queries: the warehouse jobs on stand-in tables, and the SQL they are checked by."""
