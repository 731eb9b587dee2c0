from gridmetrics.sources.clustered import read_clustered, write_clustered
from gridmetrics.sources.ingest import to_energy_table, write_both_formats, write_energy
from gridmetrics.sources.quarantine import ingest_checked, read_accepted, read_quarantine
from gridmetrics.sources.readers import (
    read_countries,
    read_energy,
    read_lines,
    register_energy,
    union_sources,
)

__all__ = [
    "ingest_checked",
    "read_accepted",
    "read_clustered",
    "read_countries",
    "read_energy",
    "read_lines",
    "read_quarantine",
    "register_energy",
    "to_energy_table",
    "union_sources",
    "write_both_formats",
    "write_clustered",
    "write_energy",
]
