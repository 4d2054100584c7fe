"""Catalogue operations as Spark DataFrame jobs."""
