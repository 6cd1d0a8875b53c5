"""Operators for building training corpora (documents, embeddings, labels).

Each module holds one operator with its own interface; ``queries`` registers them for the driver.
Nothing else in the library imports this subpackage.
"""
