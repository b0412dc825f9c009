"""Column functions: no UDFs, everything stays in JVM expressions."""

from plateflow.functions.json import has_key, json_flag, json_text
from plateflow.functions.names import (
    batch_id,
    family_of,
    image_set_id,
    job_id,
    job_name,
    parse_job_name,
)
from plateflow.functions.paths import (
    base_name,
    dir_name,
    file_url,
    icf_file,
    is_image_file,
    job_paths,
    storage_paths,
)
from plateflow.functions.ranges import parse_ranges
from plateflow.functions.timing import hours_left, progress_text

__all__ = [
    "base_name", "batch_id", "dir_name", "family_of", "file_url", "has_key", "hours_left", "icf_file",
    "image_set_id", "is_image_file", "job_id", "job_name", "job_paths", "json_flag", "json_text",
    "parse_job_name", "parse_ranges", "progress_text", "storage_paths",
]
