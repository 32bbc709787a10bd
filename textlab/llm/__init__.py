"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Every operator is a
``DataFrame -> DataFrame`` function; ``queries.py`` binds the ten operators
to the driver's tables.
"""
