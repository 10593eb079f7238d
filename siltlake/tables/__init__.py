"""Stored tables: Parquet folders, or tables of a V2 catalog.

Both give the same two kinds, and jobs name neither. A history takes batches of
streams (``append``, ``has_applied``, ``read``, ``read_batch``, ``read_since``,
``marks``); a state is merged into or replaced (``merge``, ``replace``, ``read``,
``marks``). Both know ``exists``, ``counts`` and ``stored_bytes`` where it applies.
"""

from siltlake.tables.store import ConcurrentCommitError, ParquetHistory, ParquetState

__all__ = ["ConcurrentCommitError", "ParquetHistory", "ParquetState"]
