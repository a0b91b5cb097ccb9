"""Readers and generators of the raw tables."""
