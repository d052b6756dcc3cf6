"""Expressions over Brazilian states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Official macro-regions and their states.
REGION_STATES = {
    "Norte": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MT", "MS"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}
UNKNOWN_REGION = "Unknown"


def macro_region(state: Column) -> Column:
    """Macro-region of a two-letter state code; anything else, NULL included, is ``Unknown``."""
    pairs = [F.lit(x) for region, states in REGION_STATES.items() for s in states for x in (s, region)]
    return F.coalesce(F.create_map(*pairs)[state], F.lit(UNKNOWN_REGION))
