"""Column-level helpers: dates, nulls, text rules, vectors, JSON."""
