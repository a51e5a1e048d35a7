"""Tidemark: analytics over timed, annotated recordings, on Spark DataFrames."""
