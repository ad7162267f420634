"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  ``queries`` registers one named query per
operator; ``__spark_entry__`` adds them where the subpackage is there.
"""
