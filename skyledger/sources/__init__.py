from skyledger.sources.checked import CheckFailed, observed, write_checked
from skyledger.sources.monthly import MONTH, fingerprints, month_log, month_of, month_of_day, refresh_months, scan_months
from skyledger.sources.readers import (
    MALFORMED,
    jdbc_options,
    scan_csv_strings,
    scan_delimited_checked,
    scan_delimited_noheader,
    scan_jdbc,
    scan_json_checked,
    scan_json_nested,
    scan_layer,
    scan_table,
)
from skyledger.sources.versioned import remove_old_versions, replace_table, scan_version, table_log
from skyledger.sources.writers import literal_rows, sink_overwrite, sink_overwrite_schema

__all__ = [
    "CheckFailed",
    "MALFORMED",
    "MONTH",
    "fingerprints",
    "jdbc_options",
    "literal_rows",
    "month_log",
    "month_of",
    "month_of_day",
    "observed",
    "refresh_months",
    "remove_old_versions",
    "replace_table",
    "scan_csv_strings",
    "scan_delimited_checked",
    "scan_delimited_noheader",
    "scan_jdbc",
    "scan_json_checked",
    "scan_json_nested",
    "scan_layer",
    "scan_months",
    "scan_table",
    "scan_version",
    "sink_overwrite",
    "sink_overwrite_schema",
    "table_log",
    "write_checked",
]
