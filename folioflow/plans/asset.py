"""Asset classes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from folioflow.operators.classes import asset_classes, security_classes
from folioflow.plans.build import BuildContext, builds


@builds("AssetClassification")
def asset_classification(ctx: BuildContext) -> DataFrame:
    return asset_classes(
        ctx.table("PLATO_CS_PRD_ASSET_CLS_SYS"),
        ctx.table("PLATO_CS_PRD_ASSET_CLS_SYS_TYPE"),
        ctx.table("PLATO_CS_PRD_ASSET_CLS_UD"),
        ctx.table("PLATO_CS_PRD_ASSET_CLS_UD_TYPE"),
    )


@builds("AssetClassificationRelation")
def asset_classification_relation(ctx: BuildContext) -> DataFrame:
    return security_classes(
        ctx.table("PLATO_CS_PRD_STR_CLS"),
        ctx.table("PLATO_CS_PRD_ASSET_CLS_SYS"),
        ctx.table("PLATO_CS_PRD_ASSET_CLS_UD"),
    )
