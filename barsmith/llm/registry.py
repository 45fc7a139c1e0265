"""The registered queries of the training-data operators."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from barsmith.llm import queries as q
from barsmith.llm import sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
