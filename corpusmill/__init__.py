"""Corpus curation on Spark: every operator takes a DataFrame and returns one."""
