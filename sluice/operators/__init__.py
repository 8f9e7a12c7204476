"""Operators on whole tables and logs."""
