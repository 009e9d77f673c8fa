"""Scalar and name-level functions: column-name rules (plan time) and
row-level coercions built only from ``pyspark.sql.functions``."""
