"""Writers: keyed tables, log rows and published documents."""

from statmart.sinks.documents import publish_document, publish_rows
from statmart.sinks.tables import (
    BrokenKey,
    append_rows,
    check_keys,
    replace_slice,
    replace_table,
    shape_for,
)

__all__ = [
    "BrokenKey", "append_rows", "check_keys", "publish_document", "publish_rows", "replace_slice",
    "replace_table", "shape_for",
]
