"""Operators of a training-data pipeline (language ID, dedup, decontamination,
scoring, tokenization) on Spark DataFrames. Nothing else in the library imports
this subpackage."""
