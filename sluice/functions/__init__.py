"""Scalar expressions over change events and documents."""
