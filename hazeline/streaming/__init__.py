"""Incremental jobs on landed files."""
