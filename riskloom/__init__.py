"""Transaction-risk analytics as composable PySpark DataFrame operators.

Every operator is ``(DataFrame, params) -> DataFrame``: chain them with
``df.transform`` on tables or on streams.
"""
