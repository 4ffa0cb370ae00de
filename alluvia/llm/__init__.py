"""Operators of a training-data pipeline: filters, formatting, deduplication, counting, mixing and scoring of documents."""
