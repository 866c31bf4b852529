"""Training-data operators: each module holds one operator with its own interface.

Nothing else in the library imports this subpackage; ``registry`` lists its
queries and SQL for ``__spark_entry__.py``.
"""
