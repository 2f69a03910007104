"""Association rules of trip attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytrace.operators import rules
from citytrace.session import cut_lineage
from citytrace.sources.artifacts import check_inputs
from citytrace.sources.sinks import write_rows, write_summary


def run_rules(
    trips: DataFrame,
    zones: DataFrame,
    out: str,
    min_support: float = rules.MIN_SUPPORT,
    min_confidence: float = rules.MIN_CONFIDENCE,
) -> dict[str, DataFrame]:
    """Build baskets once, mine them, write the ranked list and the showcase."""
    spark = trips.sparkSession
    baskets = cut_lineage(rules.transactions(trips, zones))
    check_inputs({"transactions": baskets})
    mined = cut_lineage(rules.rule_text(rules.mine_rules(baskets, min_support, min_confidence)))
    write_rows(rules.all_rules(mined), f"{out}/rules_all", "parquet")
    write_rows(rules.showcase(rules.rank_rules(mined)), f"{out}/rules_top", "parquet")
    listed, top = (spark.read.parquet(f"{out}/{name}") for name in ("rules_all", "rules_top"))
    metadata = rules.rule_kpis(baskets, listed, top).select(
        "*", F.lit(min_support).alias("min_support"), F.lit(min_confidence).alias("min_confidence")
    )
    write_summary(metadata, f"{out}/rules_metadata")
    return {"rules": listed, "top": top, "metadata": spark.read.json(f"{out}/rules_metadata")}
