"""Whole pipelines and the command line."""
