"""Operators for preparing language-model training corpora with Spark.

Nothing else in the library imports this subpackage.
"""
