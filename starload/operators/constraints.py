"""All declared rules of a table as one audit: a row per rule with its number of violations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.fields import too_long
from starload.operators.foreign_keys import orphan_keys
from starload.operators.keys import key_violations
from starload.spec import TableSpec


def audit(rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Columns ``rule`` and ``violations``. Foreign keys are audited only when ``parents`` is given."""
    counts = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in spec.not_null}
    counts |= {f"max_length:{c}": F.count_if(too_long(F.col(c), n)) for c, n in spec.max_length.items()}
    one_row = rows.agg(*[n.alias(rule) for rule, n in counts.items()])
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in counts]
    )
    parts = [one_row.select(F.inline(pairs))]

    surplus = key_violations(rows.where(F.col(spec.key).isNotNull()), [spec.key])
    parts.append(_total(surplus, f"primary_key:{spec.key}", F.col("rows") - 1))
    if parents is not None:
        for fk in spec.foreign_keys:
            orphans = orphan_keys(rows, fk, parents[fk.parent])
            parts.append(_total(orphans, f"foreign_key:{fk.column}", F.col("rows")))
    return reduce(DataFrame.unionByName, parts)


def _total(rows: DataFrame, rule: str, amount) -> DataFrame:
    total = F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")
    return rows.agg(total.alias("violations")).select(F.lit(rule).alias("rule"), "violations")
