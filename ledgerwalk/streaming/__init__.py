from ledgerwalk.streaming.restatement import (
    affected_months, write_fact_by_month, restate_months, start_maintenance_stream, start_restatement_stream,
)

__all__ = ["affected_months", "write_fact_by_month", "restate_months",
           "start_maintenance_stream", "start_restatement_stream"]
