"""SQL functions for stage and spider tags."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skywarden.operators.tag import STAGE_PATTERNS


def register_functions(spark: SparkSession) -> None:
    """Make ``Stage(url)`` and ``Spider(flow_id)`` callable from SQL text.

    Both are SQL functions, so the optimizer inlines them and no Python runs per row.
    """
    cases = " ".join(
        "WHEN " + " OR ".join(f"url RLIKE r'\\A(?:{p})\\z'" for p in patterns) + f" THEN '{stage}'"
        for stage, patterns in sorted(STAGE_PATTERNS.items()))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION Stage(url STRING) RETURNS STRING "
              f"RETURN CASE {cases} ELSE '0' END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION Spider(flow_id STRING) RETURNS STRING "
              "RETURN CASE WHEN flow_id IS NULL OR lower(flow_id) = 'null' THEN '0' ELSE '1' END")
