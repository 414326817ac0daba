from tablesync.sources.files import ndjson_scan, staged_scan, write_ndjson
from tablesync.sources.paged import (
    PagedSource,
    endpoint_source,
    explode_pages,
    paged_scan,
    parse_records,
)

__all__ = ["PagedSource", "endpoint_source", "explode_pages", "ndjson_scan", "paged_scan",
           "parse_records", "staged_scan", "write_ndjson"]
