"""Splicing quantification in single cells as Spark jobs."""
