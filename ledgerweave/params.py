"""Run parameters of the feed (the reference passes them from its scheduler)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values that must equal the reference's for identical output.
MAPPED_FIELD = "Cuenta"                   # CAMPO_ORIGEN of the account mapping
VOUCHER_TYPE = "AK"                       # tipo_de_comprobante, first part of the code
CURRENCY = "COP"                          # moneda
LARGE_LIMIT = 150000                      # lines above which a transaction is its own group; bin width
CODE_WIDTHS = (2, 4, 1)                   # lpad widths: voucher, sequence, re-run (they truncate too)


@dataclass(frozen=True)
class FeedParams:
    """Parameters of one run of the feed.

    ``source`` names the source system (FUENTE in the run log and the mapping) and ``book`` the ledger book.
    ``periods`` limits the run to some processing dates; ``None`` means every
    period present in the source (a backfill is one job, not one job per day).
    ``rerun`` fixes the re-run digit instead of reading it from the run log.
    ``line_block`` is the number of lines above which a transaction is cut into slices of about as many
    for line numbering (bounds the rows per task).
    """

    source: str
    book: str
    voucher: str = VOUCHER_TYPE
    currency: str = CURRENCY
    event_type: str | None = None         # defaults to the source
    source_description: str | None = None  # defaults to "MOVIMIENTO <source>"
    mapped_field: str = MAPPED_FIELD
    large_limit: int = LARGE_LIMIT
    bin_width: int | None = None          # defaults to large_limit
    voucher_width: int = CODE_WIDTHS[0]
    sequence_width: int = CODE_WIDTHS[1]
    rerun_width: int = CODE_WIDTHS[2]
    periods: tuple[dt.date, ...] | None = None
    rerun: int | None = None
    line_block: int = 1 << 20
    # a slice with more lines, which share one extraction sequence, is cut further (default 4 * line_block)
    hot_slice_rows: int | None = None
    # a small side is broadcast only up to this many bytes of values (checked); beyond, it is shuffled
    broadcast_bytes: int = 8 << 20
    # lines of a transaction per delivered file; None: one file per group, whatever its size
    rows_per_file: int | None = None
    # files by transaction code that a day of the product table is kept in; None: as the tasks write it
    buckets: int | None = None
    # bytes after which a file is cut into pieces that different tasks write; None: one task per file
    piece_bytes: int | None = 128 << 20

    def __post_init__(self):
        if self.event_type is None:
            object.__setattr__(self, "event_type", self.source)
        if self.source_description is None:
            object.__setattr__(self, "source_description", f"MOVIMIENTO {self.source}")

    @property
    def hot_slice_limit(self) -> int:
        """Slices follow the data, so one above this has many lines of one extraction sequence."""
        return int(self.hot_slice_rows or 4 * self.line_block)

    @property
    def bucket_length(self) -> tuple[int, int]:
        """Prefix lengths of the transaction code used as levels of the balancing prefix sum.

        For strings, x < y implies prefix(x) <= prefix(y), so summing inside a
        prefix and adding the totals of earlier prefixes equals one global
        running sum.  Levels: voucher + effective date (at most one per
        calendar day), then + posting date (at most one per day per effective
        date), then the codes of one date pair: the last four sequence digits
        and the re-run digits, at most 10**4 * 10**rerun_width (wider
        sequences move digits into the prefix).  Every window is bounded by
        the calendar or by the code format, however the day is shaped.
        """
        return (self.voucher_width + 8, self.voucher_width + 16 + max(0, self.sequence_width - 4))
