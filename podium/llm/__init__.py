"""Operators of a large training-data pipeline (documents, pages, benchmark, labels).

Nothing else in the library imports this subpackage.
"""
