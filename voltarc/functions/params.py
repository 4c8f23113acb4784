"""Parameters by row: a model's own where its sheet is known, else the fleet's."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config, ModelParams


def by_model(df: DataFrame, cfg: Config, of: Callable[[ModelParams], Any], default: Any) -> Column:
    """CASE model WHEN ... END; models are tens, so this stays one expression and one scan."""
    out = F.lit(default)
    if "model" in df.columns:
        for name, p in sorted(cfg.models.items()):
            out = F.when(F.col("model") == name, F.lit(of(p))).otherwise(out)
    return out
