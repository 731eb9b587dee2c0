from gridmetrics.functions.labels import canonical_country, of_country
from gridmetrics.functions.lines import parse_lines
from gridmetrics.functions.timeparts import (
    event_time,
    time_fields,
    time_text,
    with_event_time,
    with_parts,
)

__all__ = [
    "canonical_country",
    "event_time",
    "of_country",
    "parse_lines",
    "time_fields",
    "time_text",
    "with_event_time",
    "with_parts",
]
