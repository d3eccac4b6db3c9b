"""Scoring of texts as they arrive."""
