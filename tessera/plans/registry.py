"""Catalogue of registered plans: key -> Spark callable, key -> oracle SQL.

Each plan module registers its callables with ``@plan(key, sql=..., uses=...)``;
``uses`` names the stand-in CTEs (``P``, ``S``, ...) the SQL text reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.standins import with_standins

PlanFn = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, PlanFn] = {}
ORACLE: dict[str, str] = {}


def plan(key: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    def deco(fn: PlanFn) -> PlanFn:
        if key in PLANS:
            raise KeyError(f"duplicate plan key {key}")
        PLANS[key] = fn
        if sql is not None:
            ORACLE[key] = with_standins(sql, *uses) if uses else sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every plan module (registration happens at import)."""
    from tessera.plans import (  # noqa: F401
        eval_plans,
        expr_plans,
        feature_plans,
        history_plans,
        image_plans,
        lookup_plans,
        model_plans,
        profile_plans,
        report_plans,
        scoring_plans,
        source_plans,
        stream_plans,
    )
