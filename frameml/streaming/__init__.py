"""Scoring on Structured Streaming DataFrames."""
