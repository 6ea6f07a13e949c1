"""Hierarchical tabulation, protected counts and their evaluation as Spark jobs."""
