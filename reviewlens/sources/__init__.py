"""Readers, writers and the review view over the test tables."""
