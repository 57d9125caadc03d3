"""build_bridge: the first-filing to family-publication bridge with its ``lastupdate`` stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bridge import bridge
from ..sources.register import Register


def build_bridge(reg: Register, with_lastupdate: bool = True, clock: Column | None = None) -> DataFrame:
    """``clock``: the time to stamp rows with, the query's own if not given."""
    out = bridge(reg)
    return out.withColumn("lastupdate", F.current_timestamp() if clock is None else clock) if with_lastupdate else out
