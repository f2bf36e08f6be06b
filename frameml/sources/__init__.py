"""Readers for input tables and for saved models."""
