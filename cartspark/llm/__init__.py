"""Operators for training data: filters, deduplication, decontamination, mixing, counting and formatting."""
