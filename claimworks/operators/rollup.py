"""Service lines to claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_up_lines(lines: DataFrame, key: str = "claim_id") -> DataFrame:
    """``key, procedure_codes, billed_amount`` from lines ``key, ord, cpt, charge``.

    The code list keeps line order.  It holds the lines of one claim only, which the
    claim formats bound; the charge sum is combined before the shuffle.
    """
    ordered = F.sort_array(F.collect_list(F.struct("ord", "cpt")))
    return lines.groupBy(key).agg(
        F.transform(ordered, lambda x: x["cpt"]).alias("procedure_codes"),
        F.sum("charge").alias("billed_amount"),
    )
