"""Ordered-episode analytics as DataFrame operators on Spark."""
