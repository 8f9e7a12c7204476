"""Continuous application of a change log."""
