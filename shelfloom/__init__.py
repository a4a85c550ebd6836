"""Retail demand analytics as DataFrame-to-DataFrame functions on Spark."""
