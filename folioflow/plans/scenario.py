"""Scenario definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from folioflow.operators.scenario import scenario_factors
from folioflow.plans.build import BuildContext, builds


@builds("ScenarioDef")
def scenario_def(ctx: BuildContext) -> DataFrame:
    return scenario_factors(
        ctx.table("PLATO_CFG_SCENE"),
        ctx.table("PLATO_CFG_SCENE_FACTOR_SINGLE_REL"),
        ctx.table("PLATO_CFG_SCENE_FACTOR_REL_CURVE"),
        ctx.table("PLATO_CFG_FACTOR"),
    )
