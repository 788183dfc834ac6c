"""Metriclab: discovery, scoring and explanation of indicators on Spark, and guarded SQL questions."""
