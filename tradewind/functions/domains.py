"""Closed value domains of the order platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 27 Brazilian federative units, by macro-region.
STATES_BY_REGION = {
    "Norte": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MT", "MS"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}

# Order life cycle, payment methods, review scale.
ORDER_STATUSES = ("delivered", "shipped", "processing", "canceled",
                  "unavailable", "invoiced", "approved", "created")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)

STATES = tuple(state for states in STATES_BY_REGION.values() for state in states)


def state_regions(spark: SparkSession) -> DataFrame:
    """The state-to-region seed: 27 rows, so always safe to broadcast."""
    rows = [(s, region) for region, states in STATES_BY_REGION.items() for s in states]
    return spark.createDataFrame(rows, "state string, region string")
