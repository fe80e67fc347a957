"""Declared data tests of the staging views and marts, evaluated in few passes.

All NULL rules of a table are one aggregate over it; every uniqueness or relationship rule is one
more. ``failures`` returns one row per broken rule, so gating collects at most one row per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.operators import quality

# Which columns must be present, unique, or known to another table.
RULES: dict[str, dict[str, list]] = {
    "stg_obs": {"not_null": ["row_hash", "code_station", "date_obs_elab", "grandeur_hydro_elab"], "unique": ["row_hash"],
                "known": [("code_station", "stg_stations", "code_station")]},
    "stg_stations": {"not_null": ["code_station", "en_service"], "unique": ["code_station"]},
    "stg_weather": {"not_null": ["row_hash", "ville", "code_insee", "departement", "region", "date"], "unique": ["row_hash"]},
    "stg_risk_frequency": {"not_null": ["code_insee", "classe_frequence"], "unique": ["code_insee"]},
    "stg_risk_coverage": {"not_null": ["code_insee", "representativite"], "unique": ["code_insee"]},
    "dim_commune": {"not_null": ["code_insee", "ville"], "unique": ["code_insee"]},
    "dim_departement": {"not_null": ["code_departement", "departement"], "unique": ["code_departement"]},
    "dim_date": {"not_null": ["date"], "unique": ["date"]},
    "dim_station": {"not_null": ["code_station", "en_service"], "unique": ["code_station"]},
    "fct_weather": {"not_null": ["row_hash", "code_insee", "date"], "unique": ["row_hash"]},
    "fct_hydro": {"not_null": ["row_hash", "code_station", "date_obs_elab", "grandeur_hydro_elab"], "unique": ["row_hash"],
                  "known": [("code_station", "dim_station", "code_station"), ("date_obs_elab", "dim_date", "date")]},
}


class QualityGateFailed(RuntimeError):
    """A data-quality check returned offending rows; the chain stops (like a failing test run)."""


def _count(df: DataFrame, rule: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")


def failures(frames: dict[str, DataFrame]) -> DataFrame:
    """(rule, n): the broken rules of the given tables with their number of offending rows or keys.

    Relationship rules are evaluated where both tables are given.
    """
    found = []
    for table, df in frames.items():
        rules = RULES.get(table, {})
        if columns := rules.get("not_null"):
            counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            found.append(counts.select(F.inline(F.array(*[
                F.struct(F.lit(f"{table}.{c} not null").alias("rule"), F.col(c).alias("n")) for c in columns]))))
        for c in rules.get("unique", []):
            found.append(_count(quality.unique(df.select(c), c), f"{table}.{c} unique"))
        for c, parent, key in rules.get("known", []):
            if parent in frames:
                found.append(_count(quality.relationships(df.select(c), frames[parent], c, key), f"{table}.{c} in {parent}"))
    return reduce(DataFrame.unionByName, found).where(F.col("n") > 0)


def gate(frames: dict[str, DataFrame], **checks: DataFrame) -> None:
    """Raise with the names of the broken rules of ``frames`` and of the ``checks`` that return rows."""
    broken = [f"{r.rule} ({r.n})" for r in failures(frames).collect()] if frames else []
    broken += [name for name, df in checks.items() if not df.isEmpty()]
    if broken:
        raise QualityGateFailed("failed checks: " + ", ".join(broken))
