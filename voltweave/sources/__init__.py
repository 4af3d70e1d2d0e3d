from voltweave.sources.readings import (
    READINGS_SCHEMA,
    parse_date,
    profile_schema,
    read_readings,
    read_submission,
    readings_schema,
    write_predictions,
)
from voltweave.sources.staging import materialise, stage

__all__ = [
    "READINGS_SCHEMA",
    "materialise",
    "parse_date",
    "profile_schema",
    "read_readings",
    "read_submission",
    "readings_schema",
    "stage",
    "write_predictions",
]
