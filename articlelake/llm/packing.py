"""Packing: best-fit decreasing over a segment tree of remaining capacities.

Documents become token ids with a closing id; overlong ones are first cut into full windows. What
is left is shorter than a window. Best fit only asks for the tightest open window, so windows with
the same remaining capacity are interchangeable and the plan needs no more than the number of
pieces of each length: a segment tree over the capacities answers "smallest capacity of at least
l" for whole runs of windows at once. The plan is a table of runs whose size depends on the
window, not on the corpus; pieces get their place from their rank among those of their length,
which salted counts give without gathering a length in one task. The result is the same as that
of best-fit decreasing, piece by piece, over all documents.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WINDOW, END = 2048, 1
# Rows of one salt when pieces are ranked.
SALT_ROWS = 20_000

# Beyond these letters the two libraries may know different Unicode versions.
_WIDE = re.compile(rb"[\xca-\xff]")
_LONG = re.compile(rb"[^\x00-\x20]{400}")
_LOADED: dict[str, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of ``tokenizers`` for a byte-level BPE file.

    ``tiktoken`` gives the same ids three to four times faster where its rank file lies beside
    the vocabulary. It is used for texts below U+0280 without special tokens or very long words;
    all others go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        special = [t.content.encode() for t in self.exact.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else re.compile(b"(?!)")
        self.fast = None
        try:
            import public_tokenizers
            import tiktoken

            lines = open(path.removesuffix(".json") + ".tiktoken", "rb").read().splitlines()
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, FileNotFoundError):
            pass

    def ids(self, text: str) -> np.ndarray:
        raw = text.encode()
        if self.fast is None or _WIDE.search(raw) or self.special.search(raw) or _LONG.search(raw):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pieces(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of every piece of ``docs(doc_id, text)``.

    A document is its text's ids and END; it is cut into full windows and a rest. A null or empty
    text gives one piece with END alone. Repeated rows give repeated pieces. No shuffle.
    """
    path = vocabulary or default_vocabulary()
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    row = (doc.as_py(), start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
                    held += len(part) * with_ids
                if len(rows) >= 10_000 or held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(cut, kind)


class Capacities:
    """Segment tree over remaining capacities: how many open windows have each, smallest at least l."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, first: int, n: int) -> None:
        """Add ``n`` windows numbered from ``first``."""
        self.runs[capacity].append((first, n))
        self._add(capacity, n)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Remove and return a run (first, n) of at most ``most`` windows of this capacity."""
        first, n = self.runs[capacity].pop()
        if n > most:
            self.runs[capacity].append((first + most, n - most))
            n = most
        self._add(capacity, -n)
        return first, n

    def _add(self, at: int, n: int) -> None:
        at += self.base
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least ``length`` that an open window has."""
        at = length + self.base
        if self.count[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.base
            at //= 2
        return None


@dataclass(frozen=True)
class Plan:
    """Runs of pieces, by length and first rank: windows, pieces a window, offset in it."""

    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    windows: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of the pieces of given length and rank (from 0)."""
        scale = np.int64(1) << np.int64(48)
        at = np.searchsorted(self.length * scale + self.rank, length * scale + rank, side="right") - 1
        step = rank - self.rank[at]
        return self.first[at] + step // self.each[at], self.offset[at] + step % self.each[at] * length


def best_fit(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """Best-fit decreasing for so many pieces of each length, all shorter than ``window``."""
    open_, rows, used = Capacities(window), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = open_.tightest(length)
            if capacity is None:
                capacity = window
                # A new window takes pieces of this length as long as they fit.
                n = -(-left // (window // length))
                first, used = used, used + n
            else:
                first, n = open_.take(capacity, -(-left // (capacity // length)))
            each = capacity // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, first, each, window - capacity))
                rank, left = rank + full * each, left - full * each
                if capacity - each * length:
                    open_.put(capacity - each * length, first, full)
            if full < n:
                # The last window of the run takes what is left, fewer than would fit.
                rows.append((length, rank, first + full, each, window - capacity))
                open_.put(capacity - left * length, first + full, 1)
                rank, left = rank + left, 0
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Plan(*table.T, used)


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (as ``pieces`` returns it) with sequence_id and offset.

    Full windows are sequences of their own; all others are placed by best-fit decreasing over the
    whole table. Empty tables give empty results. Pieces equal in all columns are interchangeable.
    """
    columns = cut.columns
    stored = staged(cut, "pieces")
    rest = stored.where(F.col("length") < window)
    n = rest.count()
    salts = max(16, n // SALT_ROWS)
    salted = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    counts = salted.groupBy("salt", "length").agg(F.count("*").alias("n"))
    counts = staged(counts, "piece-counts")
    plan = best_fit({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("salt", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("salt", "length").orderBy("doc_id", "start", "ids_crc32")

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = plan.place(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["sequence_id", "offset"])

    ranked = (
        salted.withColumn("own", F.row_number().over(own))
        .join(offsets, ["salt", "length"])
        .withColumn("p", place(F.col("length"), F.col("before") + F.col("own") - 1))
    )
    short = ranked.select(*columns, "p.sequence_id", "p.offset")
    full = stored.where(F.col("length") == window).withColumn("sequence_id", F.monotonically_increasing_id() + plan.windows)
    return short.unionByName(full.withColumn("offset", F.lit(0).cast("long")).select(short.columns))


def padded_sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """sequence_id, ids: the sequences of ``packed`` (with ids), padded to ``window``.

    A sequence whose length is a power of two stays as it is.
    """
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("s"))
    ids = F.flatten(F.transform("s", lambda x: x.ids))
    fill = F.when(F.bit_count(F.size(ids).cast("int")) == 1, 0).otherwise(window - F.size(ids))
    return rows.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad), fill.cast("int"))).alias("ids"))
