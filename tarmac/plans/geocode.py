"""Addresses and their attempt log to one best match per address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tarmac.operators.quality import require_columns
from tarmac.operators.responses import best_matches, resolved_addresses


def build_geocoded(addresses: DataFrame, attempts: DataFrame, run_ts: Column) -> DataFrame:
    """One row per id: the best candidate, or the reason why there is none."""
    require_columns(addresses, ["id", "address"], "address_source")
    return best_matches(resolved_addresses(addresses, attempts)).withColumn("geocoded_at", run_ts)
