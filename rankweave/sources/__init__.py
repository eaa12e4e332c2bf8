"""Readers, writers and the bucketed catalogue table."""
