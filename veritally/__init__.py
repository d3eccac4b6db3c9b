"""Labelled-text preparation, scoring and classifier evaluation on Spark."""
