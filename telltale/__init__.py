"""Readings, threshold alerts, window filling and cell views as Spark jobs."""
