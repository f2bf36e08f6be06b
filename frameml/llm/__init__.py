"""Operators of a training-data pipeline: near-duplicates, decontamination,
quality, language, personal data, licences, web pages and packing."""
