"""Sources and sinks."""

from .flights import (FLIGHT_COLUMNS, LEAKAGE_COLUMNS, NA, read_flights, read_years,
                      string_schema, table, union_by_name)
from .sinks import load_model, preview, register_view, save_model, write_csv, write_results

__all__ = ["FLIGHT_COLUMNS", "LEAKAGE_COLUMNS", "NA", "read_flights", "read_years",
           "string_schema", "table", "union_by_name", "load_model", "preview", "register_view",
           "save_model", "write_csv", "write_results"]
