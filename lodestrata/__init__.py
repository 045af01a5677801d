"""Layered order, restaurant and user analytics as PySpark DataFrame jobs."""
