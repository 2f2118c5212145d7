"""Operators of a training-data pipeline: scoring, packing, filters, near copies, personal data, search.

Nothing outside this subpackage imports it.
"""
