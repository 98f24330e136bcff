"""The operators applied to the test tables, and the same results in SQL."""
