"""Native column functions: every one stays inside the JVM."""

from newsloom.functions.dates import parse_date, parse_iso
from newsloom.functions.fingerprint import fingerprint, fingerprint_by_fields, noop_fingerprint
from newsloom.functions.metadata import merge_maps, portal_name, set_default
from newsloom.functions.tags import default_tags, normalize_list, split_tags
from newsloom.functions.text import collapse_text, strip, title_or_default
from newsloom.functions.urls import origin_base, request_url, to_absolute

__all__ = [
    "collapse_text",
    "default_tags",
    "fingerprint",
    "fingerprint_by_fields",
    "merge_maps",
    "noop_fingerprint",
    "normalize_list",
    "origin_base",
    "parse_date",
    "parse_iso",
    "portal_name",
    "request_url",
    "set_default",
    "split_tags",
    "strip",
    "title_or_default",
    "to_absolute",
]
