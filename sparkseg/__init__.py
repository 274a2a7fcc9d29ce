"""Interval and transcript analytics over speech-segment tables, on Spark DataFrames."""
