"""Counting, profiling and joining; DataFrames in, DataFrames out."""
