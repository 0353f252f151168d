"""Operators of a training-data pipeline: tokenising, language, mixing, near duplicates, filters and privacy.

Nothing outside this subpackage imports it.
"""
