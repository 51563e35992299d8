"""Readers: NDJSON lines with their position, all-text CSV, JSON lists."""

from loadkit.sources.csv import scan_csv
from loadkit.sources.json_list import read_json_list
from loadkit.sources.lines import POSITION, number_lines, scan_lines

__all__ = ["POSITION", "number_lines", "read_json_list", "scan_csv", "scan_lines"]
