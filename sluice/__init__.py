"""Ordered change logs on Spark: route, gate, batch, fold, clone and compare."""
