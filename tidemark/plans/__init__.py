"""Composite plans (training prep, scoring, analysis) and the query catalog."""
