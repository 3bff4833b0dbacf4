"""Batch orchestrations composed from the operators (bootstrap, daily chain)."""
