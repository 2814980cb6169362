"""Retail lakehouse analytics as plain PySpark DataFrame jobs.

Layers: ``sources`` and ``sinks`` move data, ``operators`` hold cleaning,
business rules, eligibility, quality and lifecycle jobs, ``plans`` hold the
marts, KPIs and the end-to-end pipeline, ``streaming`` the continuous twins.
"""
