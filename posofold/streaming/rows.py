"""Assessment of a stream of instructions.

The operators are pure projections without state, so the batch functions also take a
streaming frame; nothing is aggregated and no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from posofold.operators.assess import assess
from posofold.operators.enrich import refine


def assess_stream(instructions: DataFrame, coded: bool = False) -> DataFrame:
    """Assess each arriving ``dosage``; ``coded`` also adds codes and the FHIR dosage."""
    assessed = assess(instructions)
    return refine(assessed) if coded else assessed
