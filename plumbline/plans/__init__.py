"""Whole jobs: extract, standardise, deliver."""
