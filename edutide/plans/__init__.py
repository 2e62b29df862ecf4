"""The registered queries: each operator over the given tables, with the same in SQL beside it."""
