"""Incremental loading of files as they land."""
