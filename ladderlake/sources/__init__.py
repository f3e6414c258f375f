from ladderlake.sources.clustered import write_bucketed, write_clustered
from ladderlake.sources.json_scan import (
    has_misfit,
    is_broken,
    is_misfit,
    note_load,
    parse_once,
    record_fields,
    reject_empty,
    scan_json,
    scan_records,
    split_records,
    why_rejected,
)
from ladderlake.sources.landing import (
    land_json,
    landed_files,
    landing_ranges,
    landing_report,
    latest_per_key,
    next_page,
    not_yet_loaded,
    with_pages,
)
from ladderlake.sources.listing import list_by_tasks
from ladderlake.sources.merge import merge_latest, partition_digests, publish_changed
from ladderlake.sources.tables import (
    CSV_OPTIONS,
    read_table,
    replace_values,
    write_csv,
    write_table,
)
from ladderlake.sources.versions import publish_values, publish_version, read_published

__all__ = [
    "CSV_OPTIONS",
    "has_misfit",
    "is_broken",
    "is_misfit",
    "land_json",
    "landed_files",
    "landing_ranges",
    "landing_report",
    "latest_per_key",
    "list_by_tasks",
    "merge_latest",
    "next_page",
    "not_yet_loaded",
    "note_load",
    "parse_once",
    "partition_digests",
    "publish_changed",
    "publish_values",
    "publish_version",
    "read_published",
    "read_table",
    "record_fields",
    "reject_empty",
    "replace_values",
    "scan_json",
    "scan_records",
    "split_records",
    "why_rejected",
    "with_pages",
    "write_bucketed",
    "write_clustered",
    "write_csv",
    "write_table",
]
