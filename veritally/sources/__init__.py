"""Readers for labelled corpora and probe sets."""
