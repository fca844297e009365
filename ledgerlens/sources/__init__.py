"""Readers, writers and the domain views over the test tables."""
