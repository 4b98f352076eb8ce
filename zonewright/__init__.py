"""Delivery-zone analytics as Spark DataFrame jobs.

Layout
------
functions   Column-returning helpers (rounding, time, geometry, labels)
sources     schema contracts, readers, sinks, and the mapping of the test tables
operators   reusable DataFrame -> DataFrame operators
plans       the models: staging, metrics, marts, comparison, feeds, refresh
"""
