"""Reads, writes, checkpoints, exports and test-table adapters."""

from lodestar.sources.tables import (  # noqa: F401
    append_months, checkpoint_table, export_list, load, read_delimited, stored_months,
    read_value_list, run_log_rows, write_run_log, write_scores, write_value_list,
)
