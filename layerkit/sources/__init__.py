"""Sources and sinks: CSV lines with quarantine, landed JSON pages, seeds, JDBC, tables."""

from layerkit.sources.catalog import (
    first_existing, init_table, materialize, register_views, reset_namespace,
    table_name, write_table,
)
from layerkit.sources.csv_lines import (
    field_count, literal_path, load_csv_quarantined, number_lines, parse_csv_lines, parse_csv_outcomes, read_csv_quarantined,
    read_lines, reject_report,
)
from layerkit.sources.csv_records import read_records
from layerkit.sources.page_order import cursor_of_name, cursor_of_request, pages_from_responses, rank_pages, records_in_page_order, ring_problems
from layerkit.sources.pages import chain_problems, pages_from_json, read_pages, records_from_pages
from layerkit.sources.seeds import read_relational, read_seed

__all__ = [n for n in dir() if not n.startswith("_")]
