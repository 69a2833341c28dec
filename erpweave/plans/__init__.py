"""Layered models: typed tables, dimensions and facts, KPIs, reports."""
