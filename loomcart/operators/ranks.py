"""Exact global ranks by selection: no global sort, two passes over the rows.

A sample of the rows brackets every wanted position. One scan then counts the rows between the brackets and writes out those
inside, for all orders and positions at once; the search goes on in the rows inside, which are few, until a sorted sample
is all there is. The sample only decides where to look: counts are exact, and a position that its bracket misses is looked
for where the counts say it lies.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.session import discard, materialise

#: Rows that the driver sorts at most, about.
SAMPLE = 200_000
#: Half width of a bracket, in standard deviations of a sampled position.
SPREAD = 5.0
#: Where brackets cover all rows they are made narrower, down to this.
NARROWEST = 0.001

Place = dict[str, object]  # column -> value
Wanted = Mapping[str, tuple[Sequence[str], Sequence[int]]]


def _sorted(table: pa.Table, order: Sequence[str]) -> pa.Table:
    table = table.select(list(order))
    return table.take(pc.sort_indices(table, [(c, "ascending") for c in order], null_placement="at_start"))


def _place(table: pa.Table, at: int) -> Place:
    return {c: table[c][at].as_py() for c in table.column_names}


def after(row: Place, order: Sequence[str]) -> Column:
    """True for rows that sort after ``row``, nulls first as in an ascending sort."""
    result = F.lit(False)
    for name in reversed(order):
        edge = row[name]
        larger = F.col(name).isNotNull() if edge is None else F.coalesce(F.col(name) > F.lit(edge), F.lit(False))
        result = larger | (F.col(name).eqNullSafe(F.lit(edge)) & result)
    return result


def _brackets(ordered: pa.Table, ranks: Sequence[int], total: int, spread: float) -> tuple[list[Place], set[int]]:
    """Cuts, and the numbers of the ranges between them that are brackets (range i lies behind i cuts)."""
    m = len(ordered)
    spans: list[list[int]] = []  # cuts by position in the sample: -1 is before all rows, m - 1 the last
    for rank in sorted(ranks):
        share = min(max(rank / total, 0.0), 1.0)
        width = spread * math.sqrt(max(share * (1 - share) * m, 1.0)) + 1
        low, high = max(math.floor(share * m - width), -1), min(math.ceil(share * m + width), m)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    cuts: list[Place] = []
    inside: set[int] = set()
    for low, high in spans:
        if low >= 0:
            cuts.append(_place(ordered, low))
        inside.add(len(cuts))
        if high < m:
            cuts.append(_place(ordered, high))
    return cuts, inside


def select_ranks(df: DataFrame, wanted: Wanted, total: int, depth: int = 0, spread: float | None = None) -> dict[str, dict[int, Place]]:
    """For every name the rows at the 1-based ``ranks`` of ``df`` sorted by ``order``; positions beyond the rows are left out.

    ``wanted`` gives (order, ranks) by name, and ``total`` the number of rows. Each order must identify a row. All names
    share the passes. ``depth`` and ``spread`` are of the search itself.
    """
    spread = SPREAD if spread is None else spread
    wanted = {name: (list(order), sorted({r for r in ranks if 1 <= r <= total})) for name, (order, ranks) in wanted.items()}
    found: dict[str, dict[int, Place]] = {name: {} for name in wanted}
    open_names = [name for name, (_, ranks) in wanted.items() if ranks]
    if not open_names:
        return found
    columns = list(dict.fromkeys(c for name in open_names for c in wanted[name][0]))
    rows = df.select(*columns)
    if total <= SAMPLE:
        table = rows.toArrow()
        for name in open_names:
            order, ranks = wanted[name]
            ordered = _sorted(table, order)
            found[name] = {r: _place(ordered, r - 1) for r in ranks}
        return found

    chance = F.xxhash64(*columns, F.lit(depth)) / 2.0**64 + 0.5
    sample = rows.where(chance < SAMPLE / 2 / total).toArrow()
    cuts: dict[str, list[Place]] = {}
    inside: dict[str, set[int]] = {}
    for name in open_names:
        cuts[name], inside[name] = _brackets(_sorted(sample, wanted[name][0]), wanted[name][1], total, spread)
    ranges = {f"_r{i}": sum((after(c, wanted[name][0]).cast("int") for c in cuts[name]), F.lit(0)) for i, name in enumerate(open_names)}
    ranged = rows.withColumns(ranges)
    kept = F.lit(False)
    for i, name in enumerate(open_names):
        kept = kept | F.col(f"_r{i}").isin(list(inside[name]))
    # Rows outside all brackets shrink to counts before they are shuffled.
    parts = ranged.select(
        *ranges,
        F.when(kept, F.monotonically_increasing_id()).alias("_row"),
        *[F.when(kept, F.col(c)).alias(c) for c in columns],
    )
    counted = materialise(parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("_n")), "brackets")
    sizes = counted.groupBy(*ranges).agg(F.sum("_n").alias("n")).collect()  # at most a row for each mix of ranges
    for i, name in enumerate(open_names):
        order, ranks = wanted[name]
        before = 0
        for number in range(len(cuts[name]) + 1):
            size = sum(r["n"] for r in sizes if r[f"_r{i}"] == number)
            own = [r - before for r in ranks if before < r <= before + size]
            if own:
                narrower = spread / 4 if size == total else spread  # the brackets covered everything
                if narrower < NARROWEST:
                    raise ValueError(f"rows are not told apart by {order}")
                source = counted if number in inside[name] else ranged
                deeper = select_ranks(source.where(F.col(f"_r{i}") == number), {name: (order, own)}, size, depth + 1, narrower)
                found[name] |= {before + r: place for r, place in deeper[name].items()}
            before += size
    discard(counted)
    return found


def rows_at_ranks(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> dict[int, Place]:
    """The rows at the given 1-based positions of ``df`` sorted by ``order``, which must identify a row."""
    return select_ranks(df, {"rows": (order, ranks)}, df.count())["rows"]


def with_ntiles(df: DataFrame, buckets: int, targets: dict[str, str], key: str) -> DataFrame:
    """Add one NTILE column per ``targets`` entry (new column -> ranked column); ties are broken by ``key``.

    A bucket is a comparison with the last rows of the buckets before it.
    """
    base = materialise(df, "ntile")
    total = base.count()
    size, extra = divmod(total, buckets)
    lasts = [i * size + min(i, extra) for i in range(1, buckets)]
    edges = select_ranks(base, {name: ([value, key], lasts) for name, value in targets.items()}, total)

    def bucket(name: str, value: str) -> Column:
        return sum((after(edges[name][r], [value, key]).cast("int") for r in lasts if r in edges[name]), F.lit(1))

    return base.withColumns({name: bucket(name, value) for name, value in targets.items()})
