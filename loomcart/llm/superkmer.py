"""Windows of a fixed number of tokens that also start in a document with a smaller id.

Consecutive windows that share a minimiser (the smallest hash of their grams) form a super-k-mer, and equal windows lie
in super-k-mers of equal minimisers. The work goes in four steps over packs, compressed rows of a few megabytes of text:

1. Every pack sends the distinct minimisers it has, with their numbers of super-k-mers, to the minimisers' buckets.
2. A bucket answers which of them occur in more than one document, and which are so frequent that their windows must be
   spread by the hash of the whole window instead.
3. Every pack sends the text of its super-k-mers with shared minimisers to the buckets, equal ones once and for the
   smallest document. There equal windows meet, and those of larger documents are reported.
4. Every pack marks the reported windows' tokens in its documents.

Hashes only route; windows and super-k-mers are compared by their text.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcart.llm.common import LAST_ID, text_chunks
from loomcart.session import materialise, plan_bytes, ship_package

PACK_BYTES = 4 << 20
#: Tokens that are hashed at once, so that a long document needs no more memory than others.
STEP = 1 << 18
#: Super-k-mers of one minimiser beyond which its windows are spread by their own hashes.
HOT = 20_000
BUCKET_BYTES = 1 << 20
MAX_BUCKETS = 1 << 30
MARK_BITS = 48


@dataclass(frozen=True)
class Spec:
    """Tokens in a window and in a gram; ``words`` are tokens, or else bytes."""

    window: int
    gram: int
    words: bool


@dataclass
class Pack:
    """Documents of one row: text, ids (LAST_ID for null), and first tokens and bytes of each document and of the end."""

    buffer: np.ndarray
    ids: np.ndarray
    has_id: np.ndarray
    first: np.ndarray
    #: Byte at which each token starts, and one past the last token's separator; None where tokens are bytes.
    token: np.ndarray | None

    def span(self, start: int, stop: int) -> tuple[int, int]:
        """Bytes of the tokens from ``start`` to before ``stop``, without the separator behind them."""
        if self.token is None:
            return start, stop
        return int(self.token[start]), int(self.token[stop]) - 1

    def size(self) -> int:
        return len(self.buffer) if self.token is None else len(self.token) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _words_hashed(buffer: np.ndarray, token: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every word."""
    lengths = np.diff(token)
    if not len(lengths):
        return np.empty(0, np.uint64)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(token[0], token[-1]) - np.repeat(token[:-1], lengths)
    terms = (buffer[token[0] : token[-1]].astype(np.uint64) + np.uint64(1)) * powers[place]
    return _mix(np.add.reduceat(terms, token[:-1] - token[0]))


def _grams_hashed(pack: Pack, start: int, stop: int, gram: int) -> np.ndarray:
    """Hashes of the grams that start at the tokens from ``start`` and end before ``stop``."""
    if pack.token is None:
        part = pack.buffer[start:stop]
        tokens = part.astype(np.uint64)
    else:
        tokens = _words_hashed(pack.buffer, pack.token[start : stop + 1])
    found = np.zeros(max(len(tokens) - gram + 1, 0), np.uint64)
    if pack.token is None and gram % 8 == 0:  # eight bytes at a time
        for shift in (1, 2, 4):
            tokens = tokens[:-shift] | (tokens[shift:] << np.uint64(8 * shift))
        for at in range(0, gram, 8):
            found = _mix(found * np.uint64(31) + tokens[at : at + len(found)] + np.uint64(at + 1))
        return found
    for at in range(gram):
        found = _mix(found * np.uint64(31) + tokens[at : at + len(found)])
    return found


def super_kmers(pack: Pack, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of every super-k-mer; no window crosses documents."""
    window, span = spec.window, spec.window - spec.gram + 1
    total = pack.size()
    starts, counts, marks = [], [], []
    ends = pack.first[1:]
    for begin in range(0, max(total - window + 1, 0), STEP):
        last = min(begin + STEP, total - window + 1)  # windows from begin to before last
        least = _grams_hashed(pack, begin, last + window - 1, spec.gram)
        done = 1
        while done * 2 <= span:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < span:
            least = np.minimum(least[: len(least) - (span - done)], least[span - done :])
        valid = np.ones(last - begin, bool)
        near = ends[(ends > begin) & (ends < last + window - 1)]
        crossing = (near[:, None] - np.arange(1, window)[None, :]).ravel() - begin
        valid[crossing[(crossing >= 0) & (crossing < len(valid))]] = False
        breaks = np.empty(len(valid), bool)
        breaks[:1] = True
        breaks[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
        at = np.flatnonzero(breaks)
        number = np.diff(np.append(at, len(valid)))
        good = valid[at]
        starts.append(at[good] + begin)
        counts.append(number[good])
        # Minima are small numbers; mixed again, they spread over all buckets.
        marks.append(_mix(least[at[good]]) >> np.uint64(64 - MARK_BITS))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(marks)


def _squeeze(values: np.ndarray) -> bytes:
    """Integers as zstandard of their byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(planes.T.tobytes(), 1)


def _expand(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def _bucket_of(marks: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the marks, so that a bucket's marks lie together once sorted."""
    return ((marks >> np.uint64(MARK_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


# Packs


def _freeze(column: pa.ChunkedArray) -> bytes:
    """Carried columns of a pack's rows as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    table = pa.table({"carried": column})
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return zstandard.compress(sink.getvalue().to_pybytes(), 3)


def _thaw(blob: bytes) -> pa.Array:
    return pa.ipc.open_stream(zstandard.decompress(blob)).read_all()["carried"].combine_chunks()


def _make_packs(spec: Spec) -> Callable:
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_chunks(batches, "text", PACK_BYTES):
            texts = [(t or "").encode() for t in table["text"].to_pylist()]
            if spec.words:
                texts = [b" ".join(w) + b" " if (w := t.split()) else b"" for t in texts]
            ids = table["doc_id"].to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "pack": [uuid.uuid4().hex],
                    "ids": [_squeeze(np.array([LAST_ID if i is None else i for i in ids], np.int64))],
                    "has_id": [bytes(i is not None for i in ids)],
                    "lengths": [_squeeze(np.array([len(t) for t in texts], np.int64))],
                    "text": [zstandard.compress(b"".join(texts), 3)],
                    "carried": [_freeze(table["carried"])],
                },
                schema=pa.schema([("pack", pa.string())] + [(c, pa.binary()) for c in ("ids", "has_id", "lengths", "text", "carried")]),
            )

    return make


def open_pack(row: dict, spec: Spec) -> Pack:
    raw = zstandard.decompress(row["text"]) if row["text"] else b""
    buffer = np.frombuffer(raw, np.uint8)
    first = np.concatenate([[0], np.cumsum(_expand(row["lengths"], np.int64))])
    token = None
    if spec.words:
        token = np.concatenate([[0], np.flatnonzero(buffer == 32) + 1])
        first = np.searchsorted(token, first)
    return Pack(buffer, _expand(row["ids"], np.int64), np.frombuffer(row["has_id"], bool), first, token)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


# Steps 1 and 2: which minimisers are shared


def _send_marks(spec: Spec, buckets: int) -> Callable:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pack = open_pack(row, spec)
            starts, _, marks = super_kmers(pack, spec)
            docs = np.searchsorted(pack.first, starts, "right") - 1
            order = np.lexsort((pack.ids[docs], marks)) if len(marks) else np.empty(0, np.int64)
            marks, ids = marks[order], pack.ids[docs[order]]
            new = np.ones(len(marks), bool)
            new[1:] = marks[1:] != marks[:-1]
            at = np.flatnonzero(new)
            if not len(at):
                continue
            count = np.diff(np.append(at, len(marks)))
            several = ids[at] != ids[np.append(at[1:], len(marks)) - 1]
            marks = marks[at]
            bucket = _bucket_of(marks, buckets)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            rows = {"bucket": [], "pack": [], "marks": [], "several": []}
            for a, b in zip(cuts, np.append(cuts[1:], len(marks))):
                rows["bucket"].append(int(bucket[a]))
                rows["pack"].append(row["pack"])
                rows["marks"].append(_squeeze(np.diff(marks[a:b], prepend=np.uint64(0))))
                rows["several"].append(_squeeze((np.minimum(count[a:b], 2**30) * 2 + several[a:b]).astype(np.int32)))
            yield pa.RecordBatch.from_pydict(rows, schema=_MARKS)

    return send


_MARKS = pa.schema([("bucket", pa.int64()), ("pack", pa.string()), ("marks", pa.binary()), ("several", pa.binary())])
_ANSWER = pa.schema([("bucket", pa.int64()), ("pack", pa.string()), ("flags", pa.binary())])
MARKS_SQL, ANSWER_SQL = "bucket long, pack string, marks binary, several binary", "bucket long, pack string, flags binary"


def _answer(hot: int) -> Callable:
    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in itertools.groupby(_rows(batches), key=lambda r: r["bucket"]):
            packs, parts, counts = [], [], []
            for row in rows:
                packs.append(row["pack"])
                parts.append(np.cumsum(_expand(row["marks"], np.uint64), dtype=np.uint64))
                counts.append(_expand(row["several"], np.int32).astype(np.int64))
            marks, count = np.concatenate(parts), np.concatenate(counts)
            order = np.argsort(marks, kind="stable")
            new = np.ones(len(marks), bool)
            new[1:] = marks[order[1:]] != marks[order[:-1]]
            at = np.flatnonzero(new)
            number = np.diff(np.append(at, len(marks)))
            shared = (number > 1) | (np.bitwise_or.reduceat(count[order], at) & 1 > 0)
            total = np.add.reduceat(count[order] >> 1, at)
            flags = np.empty(len(marks), np.uint8)
            flags[order] = np.repeat(shared.astype(np.uint8) + 2 * (shared & (total > hot)), number)
            split = np.split(flags, np.cumsum([len(p) for p in parts])[:-1])
            yield pa.RecordBatch.from_pydict(
                {"bucket": [bucket] * len(packs), "pack": packs, "flags": [zstandard.compress(f.tobytes(), 1) for f in split]},
                schema=_ANSWER,
            )

    return answer


# Step 3: texts of shared super-k-mers


_TEXTS = pa.schema([("bucket", pa.int64()), ("pack", pa.string()), ("ids", pa.binary()), ("at", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary())])
TEXTS_SQL = "bucket long, pack string, ids binary, at binary, sizes binary, text binary"
_COVERS = pa.schema([("pack", pa.string()), ("covers", pa.binary())])
COVERS_SQL = "pack string, covers binary"


def _covers(start: list[int], stop: list[int]) -> bytes:
    pairs = np.array([start, stop], np.int64).T
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")] if len(pairs) else pairs
    return _squeeze(np.ascontiguousarray(pairs).reshape(-1))


def _send_texts(spec: Spec, buckets: int) -> Callable:
    """For each pack, its shared super-k-mers by bucket; those equal to one of a smaller document in the pack become
    covers at once (bucket -1)."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pack = open_pack(row, spec)
            starts, counts, marks = super_kmers(pack, spec)
            known = np.unique(marks)
            answers = sorted(row["answers"], key=lambda a: a["bucket"])
            flags = np.concatenate([np.frombuffer(zstandard.decompress(a["flags"]), np.uint8) for a in answers])
            flag = flags[np.searchsorted(known, marks)]
            kept = np.flatnonzero(flag & 1)
            if not len(kept):
                continue
            starts, counts, marks, hot = starts[kept], counts[kept], marks[kept], flag[kept] & 2 > 0
            if hot.any():  # their windows travel one by one, by the hash of the whole window
                number = counts[hot]
                single = np.repeat(starts[hot] - np.append(0, np.cumsum(number)[:-1]), number) + np.arange(number.sum())
                own = np.array([_text_mark(pack, int(s), spec) for s in single], np.uint64)
                starts = np.concatenate([starts[~hot], single])
                counts = np.concatenate([counts[~hot], np.ones(len(single), np.int64)])
                marks = np.concatenate([marks[~hot], own])
            docs = np.searchsorted(pack.first, starts, "right") - 1
            ids = pack.ids[docs]
            order = np.lexsort((starts, ids))  # the smallest document comes first
            starts, counts, ids, bucket = starts[order], counts[order], ids[order], _bucket_of(marks[order], buckets)
            raw = pack.buffer.tobytes()
            smallest: dict[bytes, int] = {}
            out: dict[int, tuple[list, list, list, list]] = {}
            gone: tuple[list, list] = ([], [])
            for start, count, doc, b in zip(starts.tolist(), counts.tolist(), ids.tolist(), bucket.tolist()):
                stop = start + count + spec.window - 1
                low, high = pack.span(start, stop)
                text = raw[low:high]
                if smallest.setdefault(text, doc) < doc:
                    gone[0].append(start)
                    gone[1].append(stop)
                else:
                    for held, value in zip(out.setdefault(b, ([], [], [], [])), (doc, start, len(text), text)):
                        held.append(value)
            rows = {name: [] for name in _TEXTS.names}
            for b, (doc, at, size, text) in sorted(out.items()):
                rows["bucket"].append(b)
                rows["ids"].append(_squeeze(np.array(doc, np.int64)))
                rows["at"].append(_squeeze(np.array(at, np.int64)))
                rows["sizes"].append(_squeeze(np.array(size, np.int64)))
                rows["text"].append(zstandard.compress(b"".join(text), 3))
            if gone[0]:
                rows["bucket"].append(-1)
                rows["at"].append(_covers(*gone))
                for name in ("ids", "sizes", "text"):
                    rows[name].append(None)
            rows["pack"] = [row["pack"]] * len(rows["bucket"])
            yield pa.RecordBatch.from_pydict(rows, schema=_TEXTS)

    return send


def _text_mark(pack: Pack, start: int, spec: Spec) -> int:
    low, high = pack.span(start, start + spec.window)
    import xxhash

    return xxhash.xxh3_64_intdigest(pack.buffer[low:high]) >> (64 - MARK_BITS)


Matcher = Callable[[list[bytes], list[int]], Iterator[tuple[int, int, int]]]


def _match_bucket(spec: Spec, match: Matcher) -> Callable:
    """Equal super-k-mers leave the smallest document's; ``match`` finds equal windows among the rest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in itertools.groupby(_rows(batches), key=lambda r: r["bucket"]):
            if bucket < 0:
                for row in rows:
                    yield pa.RecordBatch.from_pydict({"pack": [row["pack"]], "covers": [row["at"]]}, schema=_COVERS)
                continue
            packs, where, docs, texts, sizes = [], [], [], [], []
            for row in rows:
                at, size = _expand(row["at"], np.int64), _expand(row["sizes"], np.int64)
                raw, end = zstandard.decompress(row["text"]), np.cumsum(size)
                docs += _expand(row["ids"], np.int64).tolist()
                where += [(len(packs), a) for a in at.tolist()]
                texts += [raw[e - s : e] for s, e in zip(size.tolist(), end.tolist())]
                packs.append(row["pack"])
            smallest: dict[bytes, int] = {}
            for text, doc in zip(texts, docs):
                if smallest.get(text, LAST_ID) >= doc:
                    smallest[text] = doc
            found: list[tuple[list, list]] = [([], []) for _ in packs]

            def cover(i: int, first: int, number: int) -> None:
                pack, at = where[i]
                found[pack][0].append(at + first)
                found[pack][1].append(at + first + number + spec.window - 1)

            left = []
            for i, (text, doc) in enumerate(zip(texts, docs)):
                if smallest[text] < doc:
                    cover(i, 0, _windows(text, spec))
                else:
                    left.append(i)
            if len(smallest) > 1:
                for i, first, number in match([texts[i] for i in left], [docs[i] for i in left]):
                    cover(left[i], first, number)
            some = [i for i, f in enumerate(found) if f[0]]
            if some:
                yield pa.RecordBatch.from_pydict(
                    {"pack": [packs[i] for i in some], "covers": [_covers(*found[i]) for i in some]}, schema=_COVERS
                )

    return run


def _windows(text: bytes, spec: Spec) -> int:
    return (text.count(b" ") + 1 if spec.words else len(text)) - spec.window + 1


# Step 4: results


def _whole_characters(raw: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone``, extended to every byte of a UTF-8 character that lost one."""
    character = np.cumsum((raw & 0xC0) != 0x80)
    broken = np.zeros(len(raw) + 1, bool)
    broken[character[gone]] = True
    return broken[character]


def _apply(spec: Spec, as_text: bool) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string() if as_text else pa.binary())]
    )

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pack = open_pack(row, spec)
            total = pack.size()
            depth = np.zeros(total + 1, np.int32)
            for blob in row["answers"] or []:
                pairs = _expand(blob, np.int64).reshape(-1, 2)
                np.add.at(depth, pairs[:, 0], 1)
                np.add.at(depth, pairs[:, 1], -1)
            removed = np.cumsum(depth[:-1]) > 0
            rows = {name: [] for name in schema.names}
            raw, held = pack.buffer.tobytes(), 0
            for i, (a, b) in enumerate(zip(pack.first[:-1].tolist(), pack.first[1:].tolist())):
                gone = removed[a:b]
                number = int(gone.sum())
                lost = _whole_characters(pack.buffer[a:b], gone) if as_text and number and pack.token is None else gone
                low, high = (a, b) if pack.token is None else (int(pack.token[a]), int(pack.token[b]))
                if not number:
                    kept = raw[low:high] if pack.token is None else raw[low : max(low, high - 1)]
                elif pack.token is None:
                    kept = pack.buffer[a:b][~lost].tobytes()
                else:
                    kept = b" ".join(w for w, g in zip(raw[low:high].split(b" "), gone.tolist()) if not g)
                rows["doc_id"].append(int(pack.ids[i]) if pack.has_id[i] else None)
                rows["n_tokens"].append(b - a)
                rows["n_removed"].append(number)
                rows["n_spans"].append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
                rows["kept"].append(kept.decode("utf-8", "ignore") if as_text else kept)
            columns = [*pa.RecordBatch.from_pydict(rows, schema=schema).columns, _thaw(row["carried"])]
            yield pa.RecordBatch.from_arrays(columns, names=[*schema.names, "carried"])

    return apply


def remove_repeats(
    docs: DataFrame,
    spec: Spec,
    match: Matcher,
    *,
    doc_id: str,
    text: str,
    hot: int = HOT,
    carry: Sequence[str] = (),
    as_text: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, n_removed, n_spans, kept`` of every input row; ``kept`` holds the tokens outside every window
    that also starts in a document with a smaller id, joined as the tokens were. The columns named in ``carry`` come
    along in the struct ``carried``. With ``as_text`` the kept bytes are text without characters that lost a byte."""
    ship_package(docs.sparkSession)
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), carried.alias("carried"))
    buckets = int(min(MAX_BUCKETS, max(64, plan_bytes(source) // BUCKET_BYTES)))
    packed = source.mapInArrow(_make_packs(spec), "pack string, ids binary, has_id binary, lengths binary, text binary, carried binary")
    packs = materialise(packed, "packs")
    marks = packs.drop("carried").mapInArrow(_send_marks(spec, buckets), MARKS_SQL)
    answers = (
        marks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answer(hot), ANSWER_SQL)
        .groupBy("pack").agg(F.collect_list(F.struct("bucket", "flags")).alias("answers"))
    )
    bare = packs.drop("carried")
    texts = bare.join(answers.hint("shuffle_hash"), "pack").mapInArrow(_send_texts(spec, buckets), TEXTS_SQL)
    # Covers that a pack has found itself need no bucket; they are spread by pack.
    dealt = texts.repartition("bucket", F.when(F.col("bucket") < 0, F.col("pack"))).sortWithinPartitions("bucket")
    covers = (
        dealt.mapInArrow(_match_bucket(spec, match), COVERS_SQL).groupBy("pack").agg(F.collect_list("covers").alias("answers"))
    )
    kinds = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_tokens", "n_removed", "n_spans")])
    kinds = kinds.add("kept", T.StringType() if as_text else T.BinaryType()).add(source.schema["carried"])
    found = packs.join(covers.hint("shuffle_hash"), "pack", "left").mapInArrow(_apply(spec, as_text), kinds)
    return found if carry else found.drop("carried")
