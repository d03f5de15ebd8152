"""Operators for preparing text corpora and matching noisy records."""
