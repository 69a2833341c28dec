"""Seeded synthetic ERP data, generated in parallel on the executors."""
