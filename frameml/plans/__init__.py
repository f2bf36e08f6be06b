"""Shared execution plans: one-pass sums, moments, split search, sampling."""
