"""Column functions: built-in expressions only, no Python UDFs."""

from .dates import (epoch_seconds, in_window, is_valid_date, parse_day, report_key, temporal_range,
                    utc_timestamp)
from .names import (chunk_key, coord_vars, folder_prefix, granule_fields, https_name, is_level2,
                    not_dir, output_name, reroot, top_folder)
from .urls import (basename, bucket_of, fixed_characters, glob_match, glob_parts, https_url, link,
                   provider, rewrite_text, s3_to_https)

__all__ = [
    "basename", "bucket_of", "chunk_key", "coord_vars", "epoch_seconds", "fixed_characters",
    "folder_prefix", "glob_match", "glob_parts", "granule_fields", "https_name", "https_url", "in_window", "is_level2",
    "is_valid_date", "link", "not_dir", "output_name", "parse_day", "provider", "report_key",
    "reroot", "rewrite_text", "s3_to_https", "temporal_range", "top_folder", "utc_timestamp",
]
