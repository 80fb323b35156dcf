"""Guards inside the job that writes a table: what must hold is measured while the rows are written.

``observe`` metrics (null counts, rates, row counts) come from the write itself, so a guard costs no extra pass; if a rule
is broken the table is not published (its folder is never handed out) and the build stops.  A lookup's unique key is
asserted by its own grouped count inside the join's plan: a repeated key raises instead of multiplying rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakekit.operators.resolve import GuardError
from lakekit.session import STAGED_CODEC, scratch_path


def write_guarded(df: DataFrame, name: str, measures: dict[str, Column], broken: Callable[[dict], list[str]],
                  keep: Column | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder and return it with its measures; ``broken`` names the rules they break.

    ``measures`` are aggregates over all rows of ``df`` (an empty table measures zeros), of which those that meet ``keep``
    are written.  With a broken rule :class:`GuardError` is raised and the table stays unpublished.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    rows = df.observe(seen, *[F.coalesce(m, F.lit(0)).alias(k) for k, m in measures.items()])
    rows = rows if keep is None else rows.filter(keep)
    rows.write.mode("overwrite").option("compression", STAGED_CODEC).parquet(path)
    values = dict(seen.get)
    faults = broken(values)
    if faults:
        raise GuardError(f"{name} is not published: " + "; ".join(faults))
    return df.sparkSession.read.parquet(path), values


def missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def none_of(**required: str) -> Callable[[dict], list[str]]:
    """Rules for measures that must be zero, with what each one means."""
    return lambda values: [f"{values[k]} {text}" for k, text in required.items() if values[k]]
