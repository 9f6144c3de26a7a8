"""Catalog data quality, localisation and reconciliation as Spark jobs."""
