"""Deterministic identifiers.

A flush is tagged with a block id. It is made of the query name, the streaming
query's persistent id (it changes with a new checkpoint, not with a restart)
and the micro-batch id: a re-run of a batch writes the same block (idempotent
landing), and no other batch ever has its id, also after a new checkpoint or
beside another stream of the same name.
"""

from __future__ import annotations

import re


def block_id(query: str, batch_id: int, source: str | None = None) -> str:
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", query if source is None else f"{query}-{source}")
    return f"{safe}-{int(batch_id):012d}"
