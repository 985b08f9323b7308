"""Readers of raw files."""

from starmill.sources.codes import read_code_tables
from starmill.sources.files import (
    arrival,
    read_default,
    read_delimited,
    read_format,
    read_inferred,
    read_json,
    read_json_mapped,
    render_path,
    stage_raw,
)
from starmill.sources.quoted import read_quoted

__all__ = [
    "arrival",
    "read_code_tables",
    "read_default",
    "read_delimited",
    "read_format",
    "read_inferred",
    "read_json",
    "read_json_mapped",
    "read_quoted",
    "render_path",
    "stage_raw",
]
