"""Operators for building training data from documents, pages, vectors and conversations."""
