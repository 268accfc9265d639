"""Flattening of nested record parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def author_names(contributors: Column) -> Column:
    """Names of the bibliographic contributors, in order.

    A deleted user has no ``data`` part; its name is then in the first entry of ``errors``.
    """
    listed = F.filter(
        contributors, lambda c: F.coalesce(c["attributes"]["bibliographic"], F.lit(False))
    )
    return F.transform(
        listed,
        lambda c: F.coalesce(
            c["embeds"]["users"]["data"]["attributes"]["full_name"],
            F.get(c["embeds"]["users"]["errors"], F.lit(0))["meta"]["full_name"],
        ),
    )


def subject_paths(subjects: Column, levels: int = 2, separator: str = " > ") -> Column:
    """One path per subject chain, cut to ``levels``; equal paths are kept."""
    return F.transform(
        subjects,
        lambda chain: F.array_join(
            F.slice(F.transform(chain, lambda s: s["text"]), 1, levels), separator
        ),
    )
