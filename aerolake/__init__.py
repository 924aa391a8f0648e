"""aerolake: aircraft-tracking analytics on Spark.

Sources and sinks move data between layers, operators answer questions, plans
are the jobs that run end to end.
"""

from aerolake.operators.emissions import co2, co2_by_type
from aerolake.operators.fleet import list_aircraft, list_enriched, positions, stats
from aerolake.session import configure

__all__ = [
    "co2",
    "co2_by_type",
    "configure",
    "list_aircraft",
    "list_enriched",
    "positions",
    "stats",
]
