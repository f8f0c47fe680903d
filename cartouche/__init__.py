"""Cartouche: label-filing analytics as Spark DataFrame jobs."""
