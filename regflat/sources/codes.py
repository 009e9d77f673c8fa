"""Code dimension (S10): ``table_name, column_name, code, description``.

The seed is a UTF-8 CSV with a header.  It is read with an explicit schema
and without trimming, because one code is a single space and codes carry
no zero padding.  The dimension is small and bounded (hundreds of rows), so
joins against it may broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CODE_SCHEMA = "table_name string, column_name string, code string, description string"


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(CODE_SCHEMA).option("header", "true").option("encoding", "UTF-8")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .option("multiLine", "true").option("escape", '"').csv(path))


def write_codes(df: DataFrame, path: str) -> None:
    (df.select("table_name", "column_name", "code", "description")
     .write.option("header", "true").option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("escape", '"').option("quoteAll", "true").csv(path))


def code_counts(codes: DataFrame) -> DataFrame:
    return codes.groupBy("table_name", "column_name").agg(F.count("*").alias("n_codes"))
