"""Composed plans: a whole synchronisation, a whole comparison."""
