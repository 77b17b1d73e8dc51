"""Near-duplicates by MinHash with sequential Bayesian verification.

Documents with equal shingle sets form one node. Nodes that share a band are candidates. A candidate's signatures are
compared batch by batch, and it is dropped once the posterior probability that its similarity reaches the threshold
falls below the chosen miss probability; survivors are verified on their full sets, rebuilt from the texts.

Pairs are never listed within a whole band bucket. First every node of a bucket meets the bucket's most central node,
the one with the smallest share of shingles that no other candidate has. Connected nodes then need no comparison. Where
a bucket still holds several components, tasks compare the nodes outside its largest one with the nodes of other
components. Large buckets are dealt out over a grid of blocks of nodes. Over the whole grid go ids, counts and signatures
only: they tell which nodes still have a partner under the exact bound from their own shingles and the Bayesian one. The
texts of those nodes follow, and their tasks return links alone.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.llm.common import LAST_ID, UPPER, text_chunks
from loomcart.session import discard, materialise, ship_package

SHINGLE = 5
#: At least so many bands, of at most ROWS hashes each: a pair of similarity 0.85 misses all bands with probability
#: (1 - 0.85^8)^40, about 3e-6. For lower thresholds ``banding`` keeps the probability at most at BAND_MISS.
BANDS, ROWS = 40, 8
BAND_MISS = 4e-6
#: Hashes of a signature beyond which bands get fewer rows.
HASHES = 384
#: Hashes kept for verification (one byte of each), and how many are compared at once.
KEPT, STEP = 128, 16
MISS = 1e-6
CHUNK_BYTES = 2 << 20
#: Members of a band bucket beyond which the nodes' own shingles are counted.
CROWD = 16
#: Members of one pair group that a task verifies against one text.
GROUP = 256
#: Nodes of a bucket that a task compares with each other; larger buckets are dealt out in blocks of so many.
BLOCK = 4096
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
_STEP_WORDS = 1 << 11


@cache
def _hash_functions(number: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240607)
    a = random.integers(0, 2**32, number, dtype=np.uint32) | np.uint32(1)
    return a[:, None], random.integers(0, 2**32, number, dtype=np.uint32)[:, None]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a UTF-8 text; shorter texts are one shingle, none has none."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    found = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        found = _mix(found * np.uint64(0x9E3779B97F4A7C15) + own[i : i + len(found)])
    return np.unique(found)


@cache
def banding(percent: int, miss: float = BAND_MISS) -> tuple[int, int]:
    """Bands and rows by which a pair at the threshold misses all bands with probability ``miss`` at most.

    The most rows that ``HASHES`` values allow, which make the fewest candidates; below about 4 percent, single values
    in as many bands as it takes.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"a threshold from 1 to 100 percent, not {percent}")
    for rows in range(ROWS, 0, -1):
        alike = (percent / 100) ** rows
        bands = max(BANDS, math.ceil(math.log(miss) / math.log1p(-alike))) if alike < 1 else BANDS
        if bands * rows <= HASHES:
            break
    return bands, rows


def signature(hashes: np.ndarray, number: int = BANDS * ROWS) -> np.ndarray:
    """``number`` MinHash values of a non-empty set."""
    a, b = _hash_functions(number)
    short = (hashes >> np.uint64(32)).astype(np.uint32)[None, :]
    least = np.full(number, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, short.shape[1], _STEP_WORDS):
        np.minimum(least, (short[:, i : i + _STEP_WORDS] * a + b).min(axis=1), out=least)
    return least


def band_keys(signed: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; equal only for equal bands of one number."""
    parts = signed.reshape(bands, rows).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return keys.view(np.int64)


def posterior(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold) after so many matches, for a uniform prior: a binomial tail of the Beta posterior."""
    n = compared + 1
    return sum(math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(matches + 1))


@cache
def fewest_matches(threshold: float, miss: float) -> tuple[tuple[int, int], ...]:
    """(hashes compared, matches below which a candidate is dropped) for each batch."""
    return tuple(
        (n, next(m for m in range(n + 1) if m == n or posterior(m, n, threshold) >= miss)) for n in range(STEP, KEPT + 1, STEP)
    )


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which rows of two byte matrices of kept hashes stay after every batch; only those still alive are compared."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, least in fewest_matches(threshold, miss):
        matches = matches + (a[alive, n - STEP : n] == b[alive, n - STEP : n]).sum(axis=1)
        good = matches >= least
        alive, matches = alive[good], matches[good]
    mask = np.zeros(len(a), bool)
    mask[alive] = True
    return mask


# Nodes

_SIGNED = "node long, has_id boolean, n long, digest binary, bands array<long>"
_POOL = "node long, n long, sig binary, packed binary"


def _signed_in(bands: int, rows: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_chunks(batches, "text", CHUNK_BYTES):
            size, digest, keys = [], [], []
            for text in table["text"].to_pylist():
                found = shingles((text or "").encode())
                size.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(signature(found, bands * rows), bands, rows) if len(found) else None)
            yield from pa.table(
                {
                    "node": table["node"],
                    "has_id": table["has_id"],
                    "n": pa.array(size, pa.int64()),
                    "digest": pa.array(digest, pa.binary()),
                    "bands": pa.array(keys, pa.list_(pa.int64())),
                }
            ).to_batches()

    return sign


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in text_chunks(batches, "text", CHUNK_BYTES):
        out: dict[str, list] = {"node": table["node"].to_pylist(), "n": [], "sig": [], "packed": []}
        for text in table["text"].to_pylist():
            raw = text.encode()
            found = shingles(raw)
            out["n"].append(len(found))
            out["sig"].append(signature(found)[:KEPT].astype(np.uint8).tobytes())
            out["packed"].append(zstandard.compress(raw, 3))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("packed", pa.binary())]))


def _own_shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle hashes with the only node of the chunk that has them, or null if several do. A half of the hash is enough:
    equal halves of different shingles only make a bound weaker."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            nodes, parts = part.column(0).to_numpy(), [shingles(zstandard.decompress(p.as_py())) for p in part.column(1)]
            hashes = (np.concatenate(parts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            owner = np.repeat(nodes, [len(p) for p in parts])
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            last = np.append(at[1:], len(hashes)) - 1
            alone = owner[at] == owner[last]
            yield pa.RecordBatch.from_pydict(
                {"h": hashes[at], "node": pa.array(owner[at], pa.int64(), mask=~alone)},
                schema=pa.schema([("h", pa.int32()), ("node", pa.int64())]),
            )


# Pairs


def _pruned(miss: float, threshold: float):
    def prune(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, KEPT) for c in (2, 3))
            mask = pa.array(survivors(a, b, threshold, miss))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return prune


def _verified(percent: int):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of (a, salt) whose first rows hold a's own sets; the others are measured against them."""
        rows = ((b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py()) for b in batches for i in range(b.num_rows))
        for (a, _), group in itertools.groupby(rows, key=lambda r: (r[0], r[1])):
            mine: list[np.ndarray] = []
            linked: dict[int, bool] = {}
            for _, _, b, packed in group:
                found = shingles(zstandard.decompress(packed))
                if b is None:
                    mine.append(found)
                    continue
                for own in mine:
                    common = len(np.intersect1d(own, found, assume_unique=True))
                    linked[b] = linked.get(b, False) or 100 * common >= percent * (len(own) + len(found) - common)
            yield pa.RecordBatch.from_pydict(
                {"a": [a] * len(linked), "b": list(linked), "linked": list(linked.values())},
                schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())]),
            )

    return verify


def _links(pairs: DataFrame, pool: DataFrame, percent: int, miss: float, label: str) -> DataFrame:
    """Linked pairs among ``pairs`` (a, b): Bayesian pruning on signatures, then full sets."""
    sig = pool.select("node", "sig")
    both = (
        pairs.join(sig.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
        .join(sig.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
        .select("a", "b", "sig_a", "sig_b")
    )
    left = materialise(both.mapInArrow(_pruned(miss, percent / 100), "a long, b long"), f"{label}-candidates").distinct()
    salts = left.groupBy("a").agg((1 + F.floor(F.count("*") / GROUP)).alias("salts"))
    salted = left.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    packed = pool.select("node", "packed")
    members = salted.join(packed.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "packed")
    heads = (
        salted.select("a", "salt").distinct().join(packed.withColumnRenamed("node", "a"), "a")
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "packed")
    )
    dealt = heads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return materialise(dealt.mapInArrow(_verified(percent), "a long, b long, linked boolean"), f"{label}-verified")


_CELL = ["band", "one", "two"]
_NARROW = [*_CELL, "block", "node", "component", "top", "n", "own", "rows", "keys", "sig"]
_CROSS = [*_NARROW, "packed"]
_SCREENED = ", ".join(f"{c} long" for c in _NARROW[:-2]) + ", keys array<long>, sig binary"


def _cells(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, bool, list[dict]]]:
    """Band, whether the cell lies between two blocks, and members of every cell; rows come sorted by cell."""
    rows = ({name: b.column(j)[i].as_py() for j, name in enumerate(names)} for b in batches for i in range(b.num_rows))
    for (band, one, two), group in itertools.groupby(rows, key=lambda r: (r["band"], r["one"], r["two"])):
        yield band, one != two, list(group)


def _partners(members: list[dict], band: int, between: bool, percent: int, miss: float) -> Iterator[tuple[int, np.ndarray]]:
    """Places of members with those of all their possible partners in other components; a pair that shares several buckets
    counts in the first."""
    node, component, n, own, rows, block = (np.array([m[c] for m in members]) for c in ("node", "component", "n", "own", "rows", "block"))
    sig = np.frombuffer(b"".join(m["sig"] for m in members), np.uint8).reshape(-1, KEPT)
    outside = component != members[0]["top"]
    keys = [set(m["keys"]) for m in members]
    for i in np.flatnonzero(outside):
        most = np.minimum(n[i] - own[i], n - own)
        fits = (100 * most >= percent * (n[i] + n - most)) | (rows[i] > 1) | (rows > 1)
        fits &= (component != component[i]) & (~outside | (node > node[i]))
        if between:
            fits &= block != block[i]
        others = np.flatnonzero(fits)
        others = others[survivors(np.broadcast_to(sig[i], (len(others), KEPT)), sig[others], percent / 100, miss)]
        others = others[[min(keys[i] & keys[j]) == band for j in others]] if len(others) else others
        if len(others):
            yield int(i), others


def _screened(percent: int, miss: float):
    """Members of each cell that have a possible partner in it."""

    def screen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in _NARROW[:-2]] + [("keys", pa.list_(pa.int64())), ("sig", pa.binary())])
        for band, between, members in _cells(batches, _NARROW):
            met: set[int] = set()
            for i, others in _partners(members, band, between, percent, miss):
                met |= {i, *others.tolist()}
            if met:
                yield pa.RecordBatch.from_pylist([members[i] for i in sorted(met)], schema=schema)

    return screen


def _crossed(percent: int, miss: float):
    """Links between components inside the cells of buckets."""

    def cross(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, between, members in _cells(batches, _CROSS):
            links = list(_cell_links(members, band, between, percent, miss))
            yield pa.RecordBatch.from_pydict(
                {"a": [a for a, _ in links], "b": [b for _, b in links]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())])
            )

    return cross


def _cell_links(members: list[dict], band: int, between: bool, percent: int, miss: float) -> Iterator[tuple[int, int]]:
    """Pairs of a cell that are linked and not yet connected."""
    label = np.array([m["component"] for m in members])
    sets: dict[int, np.ndarray] = {}

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(zstandard.decompress(members[i]["packed"]))
        return sets[i]

    for i, others in _partners(members, band, between, percent, miss):
        for j in others:
            if label[i] == label[j]:
                continue
            a, b = full(i), full(j)
            common = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * common >= percent * (len(a) + len(b) - common):
                label[label == label[j]] = label[i]
                nodes = members[i]["node"], members[j]["node"]
                yield min(nodes), max(nodes)


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node each node of an edge list (a, b) is connected to.

    Large stars and small stars in turn: every node hangs its larger neighbours, then its smaller ones, on its smallest
    neighbour, until nothing changes. Each round is written out.
    """
    edges = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        either = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = either.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = either.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        hung = small.select(F.col("m").alias("a"), "b").union(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        after = materialise(hung.where("a < b").distinct(), "edges")
        discard(edges)
        edges = after
    return edges.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "node")


def _possible(percent: int, n1: str, u1: str, n2: str, u2: str) -> Column:
    """Whether two sets may still be linked: they share at most what neither has for itself."""
    most = F.least(F.col(n1) - F.col(u1), F.col(n2) - F.col(u2))
    return 100 * most >= percent * (F.col(n1) + F.col(n2) - most)


def near_duplicates(
    docs: DataFrame, percent: int = 85, miss: float = MISS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Components of documents linked at ``100 * intersection >= percent * union`` of their word shingles.

    Words are runs of bytes other than blanks and 09-0D, with A-Z in lower case; a set holds the distinct runs of five
    words. Result, one row per input row: ``doc_id, n_shingles, component_id, kept``. Texts without words link to
    nothing and are kept. Rows with one id are one document; a null id counts as the largest id in comparisons, and its
    component is null if it holds nothing else. Extra columns are ignored; an empty table gives an empty result. Bands
    follow from ``percent``, so that pairs at a lower threshold are candidates as surely as at 85.
    """
    ship_package(docs.sparkSession)
    source = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("node"), F.col(doc_id).isNotNull().alias("has_id"), F.col(text).alias("text")
    )
    signed = materialise(source.mapInArrow(_signed_in(*banding(percent)), _SIGNED), "signed")
    full = signed.where(F.col("n") > 0)
    classes = materialise(full.groupBy("digest").agg(F.min("node").alias("rep")), "classes")
    # Equal sets are linked to their smallest document; rows of one id are one node already.
    same = full.join(classes, "digest").where("node != rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    firsts = full.join(classes, ["digest"], "inner").where("node = rep")
    bands = firsts.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.where("low < high").select("band", (F.col("members") > CROWD).alias("crowded"))
    colliding = materialise(bands.join(shared, "band"), "buckets")

    members = colliding.select("node").distinct()
    alike = classes.join(members, F.col("rep") == F.col("node"), "left_semi").select(F.col("rep").alias("node"))
    # By a shuffle at every size: a broadcast would fit small tables alone.
    texts = source.join(alike.distinct().hint("merge"), "node", "left_semi").where(F.length("text") > 0)
    pool = materialise(texts.mapInArrow(_pack, _POOL), "pool").where("n > 0")

    crowded = colliding.where("crowded").select("node").distinct()
    own = (
        pool.join(crowded, "node", "left_semi").select("node", "packed").mapInArrow(_own_shingles, "h int, node long")
        .groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count_if(F.col("node").isNull()).alias("several"))
        .where("several = 0 and low = high").groupBy(F.col("low").alias("node")).agg(F.count("*").alias("own"))
    )
    sizes = pool.groupBy("node").agg(F.max("n").alias("n"), F.min("n").alias("least"), F.count("*").alias("rows"))
    # Several texts of one id make a node without a bound.
    bounded = materialise(
        sizes.join(own, "node", "left").select(
            "node", "n", "rows", F.when(F.col("rows") == 1, F.coalesce("own", F.lit(0))).otherwise(0).alias("own")
        ),
        "bounds",
    )
    # The bound knows all nodes of crowded buckets, and only those, so it holds inside them.
    placed = (
        colliding.join(bounded, "node")
        .withColumn("own", F.when(F.col("crowded"), F.col("own")).otherwise(0))
        .where((F.col("rows") > 1) | (100 * (F.col("n") - F.col("own")) >= percent * F.col("n")))
        .select("band", "node", "n", "own", "rows")
    )
    placed = materialise(placed, "placed")
    central = placed.groupBy("band").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "node", "n", "own", "rows")).alias("c"))
    fits = (F.col("rows") > 1) | (F.col("rows2") > 1) | _possible(percent, "n", "own", "n2", "own2")
    stars = (
        placed.join(central.select("band", F.col("c.node").alias("a"), F.col("c.n").alias("n2"), F.col("c.own").alias("own2"), F.col("c.rows").alias("rows2")), "band")
        .where((F.col("node") != F.col("a")) & fits)
        .select("a", F.col("node").alias("b"))
        .distinct()
    )
    first = _links(stars, pool, percent, miss, "stars")
    linked = first.where("linked").select("a", "b")

    joined = components(linked)
    labelled = materialise(
        placed.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled"
    )
    sized = labelled.groupBy("band", "component").agg(F.count("*").alias("size"))
    largest = (
        sized.groupBy("band").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts"), F.sum("size").alias("size"))
        .where("parts > 1").select("band", F.col("top.component").alias("top"), F.ceil(F.col("size") / BLOCK).alias("blocks"))
    )
    mixed = materialise(labelled.join(largest, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")), "mixed")
    keys = mixed.groupBy("node").agg(F.collect_set("band").alias("keys"))  # at most one for each band and text of a node
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cells = F.explode(F.transform(every, lambda b: F.struct(F.least("block", b).alias("one"), F.greatest("block", b).alias("two"))))
    grid = (
        mixed.select("*", cells.alias("cell")).select("*", "cell.one", "cell.two")
        .join(keys, "node").join(pool.select("node", "sig"), "node").select(_NARROW)
    )
    screened = grid.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(_screened(percent, miss), _SCREENED)
    screened = materialise(screened, "screened")
    crossed = (
        screened.join(pool.select("node", "sig", "packed"), ["node", "sig"]).select(_CROSS)
        .repartition(*_CELL).sortWithinPartitions(*_CELL)
        .mapInArrow(_crossed(percent, miss), "a long, b long")
    )
    second = materialise(crossed, "crossed")
    for written in (colliding, pool, bounded, placed, labelled, mixed, screened):  # nothing reads these again
        discard(written)

    found = components(linked.union(second).union(same))
    return (
        signed.join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .select(
            F.when(F.col("has_id"), F.col("node")).alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("has_id") | (F.col("component") != LAST_ID), F.col("component")).alias("component_id"),
            (F.col("node") == F.col("component")).alias("kept"),
        )
    )
