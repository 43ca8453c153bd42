"""Sources and sinks."""

from smogmesh.sources.readings import (
    accepted,
    line_report,
    load_readings,
    read_readings,
    readings_view,
    rejected,
    write_readings_csv,
)

__all__ = [
    "accepted",
    "line_report",
    "load_readings",
    "read_readings",
    "readings_view",
    "rejected",
    "write_readings_csv",
]
