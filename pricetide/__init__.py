"""Retail price catalog built from captured shop pages, as Spark DataFrame jobs."""
