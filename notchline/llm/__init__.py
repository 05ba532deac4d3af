"""Operators of a training-data pipeline and their registered queries.

``QUERIES`` maps ``opN_<name>`` to a ``(spark, sf_dir) -> DataFrame`` callable,
``ORACLE`` the DuckDB twins of those that SQL expresses. Nothing outside this
subpackage imports it but ``__spark_entry__`` and ``corpus_pipeline``.
"""
