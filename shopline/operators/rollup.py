"""One scan for many aggregates: partial sums of a table at several grains.

The grains are grouping sets of one aggregate: each row is expanded once a
grain and combined map-side, so what is shuffled are groups, not rows.  The
result is stored as one table; a grain is a filter on it, and
:class:`~shopline.functions.stats.Partial` measures make coarser totals and
means from it to the same last digit as from the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shopline.session import cut_lineage

GRAIN = "_grain"


def rollup(df: DataFrame, grains: dict[str, dict[str, Column]], measures: dict[str, Column]) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Name of each grain to its groups, with the ``measures`` (aggregates) of
    each, and to the number of its groups.

    A grain maps the names of its keys to their columns.  Starts one job, which
    reads ``df`` once.
    """
    # Keys of a name may differ between grains (a day, its month), so each grain has its own.
    keys = {g: [f"{g}__{k}" for k in cols] for g, cols in grains.items()}
    with_keys = df.withColumns({f"{g}__{k}": c for g, cols in grains.items() for k, c in cols.items()})
    every = [k for of in keys.values() for k in of]
    out = with_keys.groupingSets([[F.col(k) for k in of] for of in keys.values()], *every)
    out = out.agg(F.grouping_id(*every).alias(GRAIN), *[m.alias(name) for name, m in measures.items()])
    # grouping_id sets the bit of each key that a grain lacks, the first key's the highest.
    grain_id = {g: sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k not in of) for g, of in keys.items()}
    seen = Observation(f"rollup_{uuid.uuid4().hex[:8]}")
    out = cut_lineage(out.observe(seen, *[F.count_if(F.col(GRAIN) == i).alias(g) for g, i in grain_id.items()]))
    tables = {g: out.where(F.col(GRAIN) == grain_id[g]).select(*[F.col(f"{g}__{k}").alias(k) for k in cols], *measures)
              for g, cols in grains.items()}
    return tables, {g: int(seen.get[g]) for g in grains}
