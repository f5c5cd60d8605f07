from tallywork.sources.readers import (
    conform, delivered, drift_report, parse_timestamps, read_domain, read_raw, row_counts, unparsed_counts, unparsed_report,
)
from tallywork.sources.schemas import SCHEMAS
from tallywork.sources.writers import (
    current_version, current_versions, discard, manifests, new_version, publish, read_mart, read_versions, stage_observed, stage_version,
    sweep, version_path,
    write_mart,
)

__all__ = [
    "SCHEMAS", "conform", "current_version", "current_versions", "delivered", "discard", "drift_report", "manifests", "new_version", "parse_timestamps",
    "publish", "read_domain", "read_mart", "read_raw", "read_versions", "row_counts", "stage_observed", "stage_version", "sweep", "unparsed_counts",
    "unparsed_report", "version_path", "write_mart",
]
