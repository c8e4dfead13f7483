"""Reading tenant, batch and file name out of an upload path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The upload layout is .../client_<org>/batch_<batch>/<uuid>_<file>
ORGANIZATION_PATTERN = r"client_([^/]+)"
BATCH_PATTERN = r"batch_([^/]+)"
BASENAME_PATTERN = r"[^/]+$"
UPLOAD_PREFIX_PATTERN = r"^[^_]+_"


def parse_upload_path(path: Column | str) -> dict[str, Column]:
    """Four columns by name; a part that is not in the path is null."""
    path = F.col(path) if isinstance(path, str) else path
    basename = F.regexp_substr(path, F.lit(BASENAME_PATTERN))
    return {
        "app_organization_id": F.nullif(F.regexp_extract(path, ORGANIZATION_PATTERN, 1), F.lit("")),
        "app_batch_id": F.nullif(F.regexp_extract(path, BATCH_PATTERN, 1), F.lit("")),
        "file_basename": basename,
        "original_source_file_name": F.regexp_replace(basename, UPLOAD_PREFIX_PATTERN, ""),
    }
