"""All registered queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from engage.plans import churn, evaluation, modelling, preparation, retrieval, routing, updates

FAMILIES = (churn, routing, preparation, evaluation, retrieval, updates, modelling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for family in FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
