"""Reading, writing, views, parameterised SQL, report calendar."""

from .buckets import drop_buckets, write_buckets  # noqa: F401
from .calendar import ReportCalendar, report_calendar  # noqa: F401
from .history import History, Staged  # noqa: F401
from .lines import line_counts, quarantine, read_checked, read_lines  # noqa: F401
from .schemas import read_reconciled, reconcile, wider  # noqa: F401
from .sinks import (  # noqa: F401
    export_reports,
    for_all_agents,
    write_csv,
    write_partitions,
    write_table,
)
from .tables import (  # noqa: F401
    clean_columns,
    load_tables,
    lower_columns,
    read_catalog,
    read_csv,
    read_partition,
    read_table,
    register_views,
    run_sql,
)
