"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  Each operator lives in one module with a general
interface; ``queries`` binds them to the standard tables.
"""
