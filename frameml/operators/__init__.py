"""Operators: plain functions from DataFrames to DataFrames or small models."""
