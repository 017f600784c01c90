"""The field-usage run: sampled payloads, the walk, tallies against a model, and a report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import field_usage as U
from ..operators import latest


@dataclass
class Usage:
    model: DataFrame
    extensions: DataFrame
    discovered: DataFrame
    datasets: DataFrame

    def report(self) -> str:
        return U.markdown(self.model)


def run(opportunities: DataFrame, feeds: DataFrame, model: DataFrame, category_of: Mapping[str, str], alternatives: Mapping[tuple[str, str], tuple[str, ...]], config: EngineConfig, recent_days: int | None = None) -> Usage:
    """model: category, field, model_status. Payloads are sampled per dataset, feed and kind; with `recent_days`, of the last days only."""
    rows = opportunities.where("kind is not null and feed_id is not null")
    if recent_days is not None:
        rows = rows.where(F.col("last_updated") >= F.date_sub(F.lit(config.reference_date), recent_days))
    walked = U.walk(latest.sample(rows, ["dataset_url", "feed_id", "kind"], config.usage_samples))
    classes = {"rare": config.rare_percent, "low": config.low_percent}
    return Usage(
        U.model_usage(walked, model, category_of, alternatives, **classes), U.extensions(walked, model, category_of, alternatives, **classes), U.discovered(walked, category_of, **classes),
        U.dataset_reports(walked, model, category_of, feeds),
    )
