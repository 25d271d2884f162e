"""Share of clients that completed their profile, by month of creation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from vestibule.operators.cohorts import (
    SINCE,
    completion_matrix,
    flagged_clients,
    profile_flags_by_gap,
)


def cohort_matrix(clients: DataFrame, since: date = SINCE, **patterns) -> DataFrame:
    """``(mes, m0..m6, nr)`` in percent; ``patterns`` as in ``flagged_clients``."""
    flags = profile_flags_by_gap(flagged_clients(clients, since, **patterns))
    # At most twelve rows: one task sorts them without an exchange.
    return completion_matrix(flags).coalesce(1).sortWithinPartitions("mes")
