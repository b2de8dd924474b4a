"""Operators of a training-data pipeline.

Each module holds one operator with a general interface; ``queries`` holds
the thin ``opN_<name>`` queries. Nothing else in the library imports this
subpackage.
"""
