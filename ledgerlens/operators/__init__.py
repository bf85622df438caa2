"""Operator families: SQL analytics patterns, data quality, predictive
analytics, dashboard aggregates, catalogued reports, and the scale
primitives (global rank / running share, calendar spines)."""
