"""Millrace: training-data curation and evaluation accounting on Spark."""
