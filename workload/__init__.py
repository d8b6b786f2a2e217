"""The registered queries: the library applied to the given tables, and the same in SQL."""
