"""Column expressions: JSON text, row keys and cells."""

from .encode import json_bytes, json_html_safe, json_plain
from .keys import FIXED_PATTERN, PARITY_PATTERN, row_key
from .cells import cell_rows, cell_struct, complete

__all__ = [
    "FIXED_PATTERN",
    "PARITY_PATTERN",
    "cell_rows",
    "cell_struct",
    "complete",
    "json_bytes",
    "json_html_safe",
    "json_plain",
    "row_key",
]
