"""Retail order analytics written as plain PySpark jobs."""
