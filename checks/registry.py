"""All registered queries and their SQL."""

from __future__ import annotations

from checks import oracle, queries, round_trip_oracle, round_trips

QUERIES = {**queries.QUERIES, **round_trips.QUERIES}
ORACLES = {**oracle.ORACLES, **round_trip_oracle.ORACLES}
