"""Operators for building language-model training data, on the tables documents, pages, benchmark and conversations."""
