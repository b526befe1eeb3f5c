"""Scans and sinks."""

from firmlink.sources.registry_xml import (
    flatten_registry,
    parse_registry_xml,
    read_registry_xml,
    records_from_pieces,
)
from firmlink.sources.index_hits import parse_hit_lines, read_index_hits
from firmlink.sources.tables import (
    jdbc_read_options,
    read_jdbc,
    read_pages,
    read_table,
    write_jdbc,
    write_quarantine,
    write_table,
)

__all__ = [
    "flatten_registry", "parse_registry_xml", "read_registry_xml", "records_from_pieces",
    "parse_hit_lines", "read_index_hits",
    "jdbc_read_options", "read_jdbc", "read_pages", "read_table", "write_jdbc", "write_quarantine",
    "write_table",
]
