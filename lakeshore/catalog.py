"""Where every table lives: one path function for all layers.

A lake is a root folder (any Hadoop file system: s3a://, abfss://, hdfs://,
file:/).  Tables sit at ``<root>/<layer>/<table>``; each table also has a
checkpoint, a quarantine, a change feed and a backup folder derived by the
same rule, so no job spells a path by hand (the original wrote a backup under
one name and read it under another).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

# The two schemas and their tables.
LAYERS: dict[str, list[str]] = {
    "transactional": ["companies", "customers", "products", "orders_raw", "orders"],
    "analytical": ["logs_raw", "logs"],
}
TABLE_LAYER = {t: layer for layer, tables in LAYERS.items() for t in tables}


@dataclass(frozen=True)
class Lake:
    root: str

    def _join(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def table(self, name: str) -> str:
        if name not in TABLE_LAYER:
            raise KeyError(f"unknown table {name!r}; known: {sorted(TABLE_LAYER)}")
        return self._join(TABLE_LAYER[name], name)

    def landing(self, source: str) -> str:
        """Raw files as the source systems land them (``orders``, ``combined_log``, ``job_runs``)."""
        return self._join("landing", source)

    def checkpoint(self, name: str) -> str:
        return self._join("_checkpoints", name)

    def quarantine(self, name: str) -> str:
        return self._join("_quarantine", name)

    def changes(self, name: str) -> str:
        return self._join("_changes", name)

    def backup(self, name: str) -> str:
        return self._join("_backup", name)

    def quality(self) -> str:
        return self._join("_quality")
