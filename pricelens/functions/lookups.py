"""Lookup values and the column expressions that use them.

Lookups are tiny fixed lists, so they compile to ``CASE``/``IN`` expressions
(no join, no broadcast, stays inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source system's for identical results) ---
# Carrier -> alliance; any other carrier maps to "None".
ALLIANCES = {
    "UA": "Star Alliance", "LH": "Star Alliance", "AC": "Star Alliance",
    "AA": "Oneworld", "BA": "Oneworld", "QR": "Oneworld",
    "DL": "SkyTeam", "AF": "SkyTeam", "KL": "SkyTeam",
    "WN": "None", "B6": "None", "NK": "None", "F9": "None", "G4": "None",
}
# Carriers flagged domestic.
DOMESTIC_CARRIERS = ["UA", "AA", "DL", "WN", "B6", "NK", "F9", "G4", "AS", "SY"]
# Holiday calendar used by the date dimension (data, passable as a parameter).
US_HOLIDAYS_2026 = ["2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25",
                    "2026-07-04", "2026-09-07", "2026-11-26", "2026-12-25"]
# Destinations classified as international routes.
INTERNATIONAL_AIRPORTS = ["LHR", "CDG", "FRA", "NRT", "PVG", "AMS", "GRU", "TPE", "DOH"]
# Open end of a slowly-changing-dimension validity interval.
OPEN_END = "9999-12-31"
# Z-score above which a price is an anomaly (strict).
Z_THRESHOLD = 3.0
# Seconds after the event beyond which a tick is late (strict).
ALLOWED_LATENESS_S = 120
# --- end of fixed values ---


def alliance(code: Column) -> Column:
    """Alliance of a carrier code, ``"None"`` when unknown (also for NULL)."""
    expr = F.lit("None")
    for name in ("Star Alliance", "Oneworld", "SkyTeam"):
        members = [c for c, a in ALLIANCES.items() if a == name]
        expr = F.when(code.isin(members), F.lit(name)).otherwise(expr)
    return expr


def is_domestic(code: Column) -> Column:
    return F.coalesce(code.isin(DOMESTIC_CARRIERS), F.lit(False))


def route_type(destination: Column) -> Column:
    return F.when(destination.isin(INTERNATIONAL_AIRPORTS), F.lit("International")) \
        .otherwise(F.lit("Domestic"))


def route_id(origin: Column, destination: Column) -> Column:
    """``origin-destination``; NULL if either side is NULL (like SQL ``||``)."""
    return F.concat(origin, F.lit("-"), destination)
