"""Sliding-window statistics over streams and tables of numeric indicators, on Spark."""
