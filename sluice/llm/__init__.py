"""Operators for building language-model training corpora from tables of documents."""
