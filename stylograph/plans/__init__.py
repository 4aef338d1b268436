"""Whole runs: curation, preprocessing and experiments."""
