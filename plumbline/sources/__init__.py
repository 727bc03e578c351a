"""Readers, writers and dataset layout."""
