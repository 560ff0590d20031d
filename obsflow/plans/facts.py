"""Facts with their location key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from obsflow.functions.times import audit_stamp
from obsflow.operators.clean import clean_facts, project_fact
from obsflow.operators.keys import lookup_location
from obsflow.operators.lookup import BROADCAST_BYTES
from obsflow.schemas import FACT_COLUMNS


def fact_with_fk(
    processed: DataFrame,
    locations: DataFrame,
    run_ts: datetime,
    *,
    use_coords: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Facts keyed by city; a fact without a known city is kept with a NULL key.

    ``use_coords`` also lets the coordinates find the location, which gives a
    key to facts that have no city.
    """
    if use_coords:
        facts = clean_facts(processed.select(*FACT_COLUMNS, "lat", "long"))
    else:
        facts = clean_facts(project_fact(processed))
    keyed = lookup_location(
        facts,
        locations,
        use_coords=use_coords,
        broadcast_bytes=broadcast_bytes,
    )
    return audit_stamp(keyed.drop("city", "lat", "long"), run_ts)
