"""Operators and pipeline stages for training corpora."""
