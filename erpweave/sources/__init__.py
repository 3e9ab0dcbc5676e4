"""Readers, writers, schema conformance and source registries."""

from erpweave.sources.audit import AuditedSources, SourceAudit
from erpweave.sources.conform import conform, conform_rejects
from erpweave.sources.damaged import CsvLanes, read_csv_lanes
from erpweave.sources.readers import read_csv_file, read_csv_typed, read_table
from erpweave.sources.registry import SourceRegistry, Sources, SystemLocation, load_all
from erpweave.sources.sinks import read_written, write_table

__all__ = [
    "AuditedSources",
    "CsvLanes",
    "SourceAudit",
    "SourceRegistry",
    "Sources",
    "SystemLocation",
    "conform",
    "conform_rejects",
    "load_all",
    "read_csv_file",
    "read_csv_lanes",
    "read_csv_typed",
    "read_table",
    "read_written",
    "write_table",
]
