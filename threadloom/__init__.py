"""Batch analytics over question-and-answer archives, expressed as Spark DataFrames."""
