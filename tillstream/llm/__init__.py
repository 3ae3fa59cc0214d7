"""Operators for building a training corpus from a table of documents."""
