"""Whole runs: train, score, evaluate, probe."""
