"""Column functions: JSON documents (``jsonfn``) and epoch times (``timefn``)."""

from shoal.functions.jsonfn import (
    bind_once,
    doc_keys,
    doc_to_json,
    json_copy,
    json_find,
    json_has,
    json_put,
    json_replace,
    json_rewrite,
    json_sanitize_keys,
    parse_doc,
)
from shoal.functions.timefn import (
    epoch_date,
    epoch_datetime,
    epoch_hour,
    epoch_is_digits,
    epoch_millis,
    normalize_epoch,
    plausible_epoch,
    valid_epoch,
)

__all__ = [
    "bind_once", "doc_keys", "doc_to_json", "json_copy", 
    "json_find", "json_has", "json_put", "json_replace", "json_rewrite", "json_sanitize_keys",
    "parse_doc", "epoch_date", "epoch_datetime", "epoch_hour", "epoch_is_digits",
    "epoch_millis", "normalize_epoch", "plausible_epoch", "valid_epoch",
]
