"""Relational operators: features, customer 360, churn, DQ, claims, underwriting, writes."""
