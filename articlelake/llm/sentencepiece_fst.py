"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model file is compiled into

- a normaliser: one state, each character to itself, space to the word mark, a mark before the text;
- a piece transducer: an arc for each piece, reading its text and writing its id;
- byte fallback: a character that no piece covers writes the ids of its UTF-8 bytes;
- a pair automaton that remembers the last piece written.

An input is composed with these as it is read, and the shortest path in the tropical semiring (min,
+) is kept for every position. In a unigram model an arc weighs minus the piece's log-probability.
In a BPE model a sequence of pieces is the encoding exactly if every piece, and every two
neighbours, are the encoding of their own text, so the pair automaton weighs 0 for such pairs and
infinity for all others, and the path of finite weight is the one that the merges give.

Where no piece can span two neighbouring characters the input is cut; the parts recur, so their
paths are kept in a bounded table per task process.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
INFINITE = float("inf")
# Paths and pair weights kept per process, and the longest part kept.
KEPT, KEPT_PAIRS, KEPT_CHARS = 600_000, 300_000, 48

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message: integers, 4-byte floats, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
        elif kind == 5:
            yield number, float(np.frombuffer(data[at : at + 4], "<f4")[0])
            at += 4
        elif kind == 1:
            yield number, data[at : at + 8]
            at += 8
        else:
            size = varint()
            yield number, data[at : at + size]
            at += size


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            proto = file.read()
        self.pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = b"", b""
        for number, value in _fields(proto):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = value
            elif number == 3:
                normalizer = value
        self.kind = dict(_fields(trainer)).get(3, UNIGRAM)
        spec = dict(_fields(normalizer))
        if spec.get(2) or spec.get(6) or self.kind not in (UNIGRAM, BPE) or any(t == USER for _, _, t in self.pieces):
            raise ValueError("only identity normalisers and unigram or BPE models without user-defined symbols are compiled")
        self.dummy_prefix, self.remove_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t in (NORMAL, UNUSED)}
        self.scores = {p: self.pieces[i][1] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        self.parts = self._cuts()
        self.inner = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # What each id stands for when decoding: text bytes, with the mark as a space.
        self.texts = [
            bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(MARK, " ").encode()
            for p, _, t in self.pieces
        ]
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}
        self.worst = min(self.scores.values(), default=0.0) - 10.0
        # Two generations: when the newer is full it becomes the older, so that frequent parts stay.
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], float] = {}

    def _cuts(self) -> re.Pattern:
        """Pattern of parts that no piece spans: around characters in no longer piece, before runs of marks."""
        sticky = "".join(map(re.escape, sorted({c for p in self.ids if len(p) > 1 for c in p} - {MARK})))
        if not sticky or any(MARK in p.lstrip(MARK) for p in self.ids):
            return re.compile(r"(?s).+")
        return re.compile(f"{MARK}*[{sticky}]+|{MARK}+|[^{sticky}{MARK}]")

    def merged(self, text: str) -> list[str]:
        """Pieces that the merges give for a short text: best score first, then leftmost."""
        symbols: list[str | None] = list(text)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        scores = self.scores
        heap = [(-scores[a + b], i, a + b) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in scores]
        heapify(heap)
        while heap:
            _, left, whole = heappop(heap)
            right = after[left]
            if symbols[left] is None or right < 0 or symbols[left] + symbols[right] != whole:
                continue
            symbols[left], symbols[right] = whole, None
            follower = after[left] = after[right]
            if follower >= 0:
                before[follower] = left
                if (new := whole + symbols[follower]) in scores:
                    heappush(heap, (-scores[new], left, new))
            leader = before[left]
            if leader >= 0 and (new := symbols[leader] + whole) in scores:
                heappush(heap, (-scores[new], leader, new))
        return [s for s in symbols if s is not None]

    def pair_weight(self, last: str, piece: str) -> float:
        """BPE weight of writing ``piece`` after ``last`` ('' at the start)."""
        weight = self.pairs.get((last, piece))
        if weight is None:
            weight = 0.0 if self.merged(last + piece) == ([last, piece] if last else [piece]) else INFINITE
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[last, piece] = weight
        return weight

    def path(self, part: str) -> list[str]:
        """Shortest path of the composition of one part with the model, as pieces."""
        n, longest = len(part), self.longest
        scores, pairs, pair = self.scores, self.pairs, self.pair_weight
        unigram = self.kind == UNIGRAM
        # For each position the last piece of the shortest path so far, where it began, and the weight.
        last, origin, weight = [""] * (n + 1), [0] * (n + 1), [0.0] * (n + 1)
        for end in range(1, n + 1):
            best = INFINITE
            for at in range(end - longest if end > longest else 0, end):
                piece = part[at:end]
                if piece in scores or at == end - 1:  # byte fallback: a character stands for its bytes
                    if unigram:
                        new = weight[at] - scores.get(piece, self.worst)
                    else:
                        previous = last[at]
                        new = pairs.get((previous, piece))
                        if new is None:
                            new = pair(previous, piece)
                    if new < best:
                        best, last[end], origin[end] = new, piece, at
                        if not unigram:
                            break  # weight 0: none is less
            weight[end] = best
        out, at = [], n
        while at:
            out.append(last[at])
            at = origin[at]
        return out[::-1]

    def ids_of(self, part: str) -> bytes:
        """Ids of one part as packed 32-bit integers; cut again where two characters meet in no piece."""
        found = self.paths.get(part)
        if found is None and (found := self.older.get(part)) is not None:
            self._keep(part, found)
        if found is None:
            inner = self.inner
            cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in inner]
            if cuts:
                found = b"".join(map(self.ids_of, map(part.__getitem__, map(slice, [0, *cuts], [*cuts, len(part)]))))
            else:
                found = self._written(part)
            if len(part) <= KEPT_CHARS:
                self._keep(part, found)
        return found

    def _keep(self, part: str, found: bytes) -> None:
        if len(self.paths) >= KEPT // 2:
            self.older, self.paths = self.paths, {}
        self.paths[part] = found

    def _written(self, part: str) -> bytes:
        packed = self.packed
        return b"".join([packed.get(p) or self._fallback(p) for p in self.path(part)])

    def _fallback(self, character: str) -> bytes:
        ids = [self.bytes[b] for b in character.encode()] if self.bytes else [self.unknown]
        return np.array(ids, "<i4").tobytes()

    def normalise(self, text: str) -> str:
        if self.remove_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARK)
        return MARK + text if self.dummy_prefix and text else text

    def encode(self, text: str | None) -> np.ndarray:
        kept, slow = self.paths, self.ids_of
        parts = self.parts.findall(self.normalise(text or ""))
        return np.frombuffer(b"".join([kept.get(p) or slow(p) for p in parts]), "<i4")

    def decode(self, ids) -> str:
        """Text of a sequence of ids; bytes that are no UTF-8 become U+FFFD."""
        texts = self.texts
        raw = b"".join([texts[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        text = raw.decode("utf-8", "replace")
        return text.removeprefix(" ") if self.dummy_prefix else text


_LOADED: dict[str, Transducer] = {}


def transducer(path: str | None = None) -> Transducer:
    """One compiled model per process."""
    path = path or default_model()
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def encode_column(text: Column, path: str | None = None) -> Column:
    """Column of piece ids; null and empty texts have none."""
    path = path or default_model()

    @F.arrow_udf("array<int>")
    def encode(array: pa.Array) -> pa.Array:
        model = transducer(path)
        return pa.array([model.encode(v.as_py()) for v in array], pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, path: str | None = None) -> Column:
    """Column of texts; null ids give null."""
    path = path or default_model()

    @F.arrow_udf("string")
    def decode(array: pa.Array) -> pa.Array:
        model = transducer(path)
        return pa.array([None if not v.is_valid else model.decode(v.values.to_numpy()) for v in array], pa.string())

    return decode(ids)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32, n_bytes_ids, decoded_sha256, exact for every row of ``docs(doc_id, text)``.

    ids_crc32 is over the ids as little-endian 32-bit integers, n_bytes_ids counts ids of bytes, and
    exact says whether decoding gives the text back (false for texts with a word mark or, by the
    model's rule, none other). Null and empty texts have no ids, decode to the empty text and are
    exact. Repeated rows give repeated results; other columns are ignored. One pass, no shuffle,
    and ids never leave the task.
    """
    path = path or default_model()

    @F.arrow_udf("struct<n_ids:long,ids_crc32:long,n_bytes_ids:long,decoded:string>")
    def trip(array: pa.Array) -> pa.Array:
        model = transducer(path)
        low, high = min(model.bytes.values(), default=0), max(model.bytes.values(), default=-1)
        rows = []
        for value in array:
            ids = model.encode(value.as_py())
            rows.append((len(ids), zlib.crc32(ids.tobytes()), int(((ids >= low) & (ids <= high)).sum()), model.decode(ids)))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["n_ids", "ids_crc32", "n_bytes_ids", "decoded"])

    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t", trip("text"))
    return found.select(
        "doc_id", "t.n_ids", "t.ids_crc32", "t.n_bytes_ids",
        F.sha2(F.col("t.decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("t.decoded") == F.col("text")).alias("exact"),
    )
