"""Landed files, listings and extracts as DataFrames."""
