"""Marts, KPIs and the end-to-end pipeline."""
