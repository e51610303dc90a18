"""The identity of a write: a load, and a batch of it.

Batch ids of a stream start at 0 with every checkpoint, so they name a write only together with
the load they belong to: the id of the streaming query, which its checkpoint keeps, or one that
the caller of a batch load gives. The same load and batch written again replaces what it wrote;
another load adds to it.
"""

from __future__ import annotations

import re

LOAD_ID, BATCH_ID = "load_id", "batch_id"
#: The load of a caller who names none.
DEFAULT_LOAD = "load"


def checked_load(load_id: str) -> str:
    """A load's id goes into paths and statements, so it has letters, digits, ``_`` and ``-`` only."""
    if not re.fullmatch(r"[0-9A-Za-z_-]+", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    return load_id


def batch_folder(folder: str, batch_id: int, load_id: str = DEFAULT_LOAD) -> str:
    return f"{folder.rstrip('/')}/{LOAD_ID}={checked_load(load_id)}/{BATCH_ID}={int(batch_id)}"
