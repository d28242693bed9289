"""Retail sales analytics as Spark jobs: clean, model, check, publish, report."""
