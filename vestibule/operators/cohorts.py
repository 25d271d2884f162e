"""How long clients take to complete their profile, by month of creation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.functions.days import whole_months
from vestibule.functions.measures import contains_any, flag, percent

# The texts searched for in a profile, the person type that is
# reported, the first day of creation and the months shown.
NO_PROFILE = ("Sem Perfil",)
KNOWN_PROFILES = ("Conservador", "Moderado", "Arrojado")
PERSON_TYPE = "F"
SINCE = date(2023, 7, 1)
BUCKETS = range(7)


def flagged_clients(
    clients: DataFrame,
    since: date = SINCE,
    person_type: str = PERSON_TYPE,
    no_profile: Sequence[str] = NO_PROFILE,
    known_profiles: Sequence[str] = KNOWN_PROFILES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(mes, gap, sem, com)`` per client: creation month, months to update, flags.

    The columns named in ``carry`` stay beside them.

    ``sem`` marks a client without a profile, ``com`` one with a known profile;
    any other text is neither. There is no upper date bound and ``mes`` is the
    month number, so equal months of different years fall together.
    """
    profile = F.col("perfil")
    return clients.filter(
        (F.col("tp_pessoa") == person_type) & (F.col("dt_criacao") >= F.lit(since))
    ).select(
        F.month("dt_criacao").alias("mes"),
        whole_months(F.col("dt_atualiz"), F.col("dt_criacao")).alias("gap"),
        flag(profile.isNull() | contains_any(profile, no_profile)).alias("sem"),
        flag(contains_any(profile, known_profiles)).alias("com"),
        *carry,
    )


def profile_flags_by_gap(flagged: DataFrame) -> DataFrame:
    """``(mes, gap, sem, com)`` summed per creation month and gap."""
    return flagged.groupBy("mes", "gap").agg(
        F.sum("sem").alias("sem"), F.sum("com").alias("com")
    )


def completion_matrix(flags: DataFrame, buckets: Sequence[int] = BUCKETS) -> DataFrame:
    """``(mes, m<gap>..., nr)``: percentage of flagged clients by gap, and without profile.

    A cell is null when no client of the month has that gap and 0 when some
    have, none of them with a known profile. Gaps outside ``buckets`` and null
    gaps count in the denominator only, so a row need not add up to 100.

    ``flags`` may be the summed flags or the clients' own: the result is the
    same. Summed first, the masked sums run over a few rows per month and gap
    and not over every client, which is cheaper by more than the added shuffle
    of those rows costs.
    """
    total = F.col("sem") + F.col("com")
    sums = flags.groupBy("mes").agg(
        F.sum("sem").alias("sem"),
        F.sum("com").alias("com"),
        *[F.sum(F.when(F.col("gap") == k, F.col("com"))).alias(f"m{k}") for k in buckets],
    )
    return sums.select(
        "mes",
        *[percent(F.col(f"m{k}"), total).alias(f"m{k}") for k in buckets],
        percent(F.col("sem"), total).alias("nr"),
    )
