"""Arrow batches in pieces, so that what a task holds as Python objects is bounded."""

from __future__ import annotations

from collections.abc import Iterator

ROWS_AT_ONCE = 256


def pieces(batches: Iterator, rows: int = ROWS_AT_ONCE) -> Iterator:
    """Slices of at most ``rows`` rows of record batches; empty batches give none."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
