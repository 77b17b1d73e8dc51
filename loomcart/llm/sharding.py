"""Shards of nearly equal size by sampled splitters.

Rows are ordered by a hash of their text and, within equal texts, by a written row number. A size-weighted sample of the
keys gives quantiles as candidate cuts, whose bytes are then summed exactly. A range that holds a wanted boundary and is
still too full is sampled and cut again, until every boundary lies within the tolerance. Cuts fall between groups of equal
texts; only a group that is itself too large for one side is cut between its rows. All work on rows is column expressions;
the driver reads a bounded sample and one sum for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.session import materialise

#: Ranges that a round cuts what it looks at into, and sampled rows for each.
RANGES, SAMPLES = 256, 16
#: A boundary may miss its place by this share of a shard; groups of equal texts up to ``WHOLE`` of a shard stay whole.
TOLERANCE, WHOLE = 0.002, 0.02
#: Rows that are numbered in one group: 2 to this power.
BLOCK_BITS = 17

Cut = tuple[int, int]  # key and row number; rows from here on lie behind the cut
FIRST_ROW = -1
START, END = (-(2**63), FIRST_ROW), (2**63, FIRST_ROW)


@dataclass(frozen=True)
class Range:
    """Where a boundary lies: between two cuts, with the exact bytes before each."""

    low: Cut
    high: Cut
    before_low: int
    before_high: int

    @property
    def size(self) -> int:
        return self.before_high - self.before_low

    @property
    def one_group(self) -> bool:
        return self.high[0] <= self.low[0] + (self.high[1] == FIRST_ROW)

    @property
    def one_row(self) -> bool:
        return self.one_group and self.high[0] == self.low[0] and self.high[1] <= self.low[1] + 1


def cuts_before(cuts: Sequence[Cut]) -> Column:
    """How many of the sorted cuts lie at or before a row, by binary search."""
    if not cuts:
        return F.lit(0)
    known = F.expr(f"array({', '.join(f"named_struct('key', {k}L, 'row', {r}L)" for k, r in cuts)})")
    here = F.struct(F.col("_key").alias("key"), F.col("_row").alias("row"))
    steps = F.lit([1 << b for b in reversed(range(len(cuts).bit_length()))])

    def step(n: Column, s: Column) -> Column:
        return F.when((n + s <= len(cuts)) & (F.get(known, n + s - 1) <= here), n + s).otherwise(n)

    return F.aggregate(steps, F.lit(0), step)


def _edges(ranges: Sequence[Range]) -> list[Cut]:
    return sorted({c for r in ranges for c in (r.low, r.high)} - {START, END})


def _candidates(span: Range, sample: list[tuple[Cut, float]], wanted: int) -> set[Cut]:
    """Quantiles of a weighted sample as cuts inside a range; a heavy group is cut off on both sides."""
    total = sum(w for _, w in sample)
    by_group: dict[int, float] = {}
    for (key, _), weight in sample:
        by_group[key] = by_group.get(key, 0.0) + weight
    out: set[Cut] = set()
    done, number = 0.0, 0
    for (key, row), weight in sorted(sample):
        done += weight
        if done * wanted >= number * total:
            number = int(done * wanted / total) + 1
            if span.one_group:
                out |= {(key, row), (key, row + 1)}
            else:
                out.add((key, FIRST_ROW))
                if by_group[key] * wanted > total:
                    out.add((key + 1, FIRST_ROW))
    return {c for c in out if span.low < c < span.high}


def splitters(rows: DataFrame, shards: int) -> list[Cut]:
    """The cuts between the shards of ``rows`` (``_key, _row, size``)."""
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    share = total / shards
    found = [Range(START, END, 0, total) for _ in range(1, shards)]
    settled: set[Range] = set()
    turn = 0

    def finished(r: Range) -> bool:
        return r in settled or r.size <= share * TOLERANCE or r.one_row or (r.one_group and r.size <= share * WHOLE)

    while open_ranges := sorted({r for r in found if not finished(r)}, key=lambda r: r.low):
        turn += 1
        edges = _edges(open_ranges)
        place = cuts_before(edges)
        numbers = {sum(c <= r.low for c in edges): r for r in open_ranges}  # low is an edge or the start
        each = max(2, RANGES // len(numbers))
        rates = ", ".join(f"{n}, double('{each * SAMPLES / r.size!r}')" for n, r in numbers.items())
        rate = F.element_at(F.expr(f"map({rates})"), F.col("_range"))
        chance = F.xxhash64("_key", "_row", F.lit(turn)) / 2.0**64 + 0.5
        inside = rows.withColumn("_range", place).where(F.col("_range").isin(list(numbers)))
        drawn = inside.withColumn("_rate", rate).where(chance < F.col("size") * F.col("_rate"))
        samples: dict[int, list[tuple[Cut, float]]] = {n: [] for n in numbers}
        for r in drawn.select("_range", "_key", "_row", F.greatest("size", 1 / F.col("_rate")).alias("weight")).collect():
            samples[r["_range"]].append(((r["_key"], r["_row"]), r["weight"]))
        inner = {n: _candidates(numbers[n], samples[n], each) for n in numbers}
        cuts = sorted(set(edges).union(*inner.values()))
        sums = rows.groupBy(cuts_before(cuts).alias("range")).agg(F.sum("size").alias("size")).collect()
        own = {r["range"]: int(r["size"]) for r in sums}
        before = dict(zip([START, *cuts, END], accumulate([0] + [own.get(n, 0) for n in range(len(cuts) + 1)])))
        for n, r in numbers.items():
            if samples[n] and not inner[n]:
                settled.add(r)  # nothing inside to cut at
        for i, r in enumerate(found):
            if r in numbers.values():
                target = share * (i + 1)
                at = sorted(c for c in before if r.low <= c <= r.high)
                low = max(c for c in at if before[c] <= target or c == r.low)
                high = min(c for c in at if c > low)
                found[i] = Range(low, high, before[low], before[high]) if (low, high) != (r.low, r.high) else r
    chosen = [r.low if share * (i + 1) - r.before_low <= r.before_high - share * (i + 1) else r.high for i, r in enumerate(found)]
    return list(accumulate(chosen, max))


def shard_records(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Every row with its shard and place: ``doc_id, size, text_crc32, shard, slot``, and ``carried`` with the columns named.

    A row's size is the UTF-8 bytes of its text and 1; sizes of shards are near equal: a boundary misses its place by at
    most half of the larger of one row, 0.2 % of a shard and a group of equal texts of up to 2 % of a shard. Groups of
    equal texts lie in one shard unless a boundary falls into a larger one. Slots run from 0 without gaps. Null and empty
    texts are equal and of size 1; repeated rows and null ids are rows of their own; columns not named in ``carry`` are
    ignored; an empty table gives no row, and shards may stay empty where there are few rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    whole = F.coalesce(F.col(text), F.lit(""))
    others = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    numbered = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        F.xxhash64(whole).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
        *others,
    )
    # Written, so that a row keeps its number when a task is repeated.
    rows = materialise(numbered, "sharded")
    cuts = splitters(rows.select("_key", "_row", "size"), shards)
    placed = rows.withColumns({"shard": cuts_before(cuts).cast("int"), "_block": F.shiftright("_row", BLOCK_BITS)})
    within = Window.partitionBy("shard", "_block").orderBy("_row")
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("rows"))
    bases = counts.select("shard", "_block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return (
        placed.withColumn("_place", F.row_number().over(within))
        .join(bases, ["shard", "_block"])
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("_place") - 1).alias("slot"), *["carried"] * bool(carry)
        )
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """Parquet files of each shard, in slot order, in folders ``shard=0`` and so on."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
