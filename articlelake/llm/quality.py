"""Quality classifier: hashed subword embeddings averaged per document, softmax output.

Features of a text are its words, a marker for each word that says whether it repeats the word
before it, and all byte 2- to 4-grams inside a word and its bounding spaces. Each is hashed to a
row of an embedding table; a document is the weighted average of its rows. Table and softmax are
learned by numpy stochastic gradient descent (Adagrad) on a bounded sample of labelled rows.

The output is linear in the average, so scoring needs one number per row of the table: a text is
scored in one vectorised pass over its bytes, whole, in blocks of about a megabyte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, discard, encoded, fold, labelled_rows, staged

BUCKETS = 1 << 16
REPEAT, FRESH = BUCKETS, BUCKETS + 1
DIM = 8
WORD_WEIGHT = 4.0
# Sample bound of the fit: rows per label.
TRAIN_ROWS = 2500
# Shares in which the vectors of the sample come to the driver.
FETCHES = 8

_SPREAD = {2: np.uint32(2654435761), 3: np.uint32(2246822519), 4: np.uint32(3266489917)}
_P = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POWER: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWER or next(iter(_POWER)) < n:
        size = max(n, CHUNK_BYTES * 2)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        _POWER.clear()
        _POWER[size] = (_powers(_P, size), _powers(inverse, size))
    return next(iter(_POWER.values()))


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, bucket, weight) of every feature in blocks of bytes.

    ``data`` holds blocks that begin at ``starts``, each with a space at both ends.
    """
    n = len(data)
    space = data <= 32
    wide = np.zeros(n + 4, np.uint32)
    wide[:n] = data
    code = wide[:n] | (wide[1 : n + 1] << np.uint32(8)) | (wide[2 : n + 2] << np.uint32(16)) | (wide[3 : n + 3] << np.uint32(24))
    padded = np.ones(n + 4, bool)
    padded[:n] = space
    s1, s2, s3 = padded[1 : n + 1], padded[2 : n + 2], padded[3 : n + 3]
    where, bucket, weight = [], [], []
    masks = {2: ~(space & s1), 3: ~s1, 4: ~(s1 | s2)}
    masks[2][-1:] = False
    masks[3][-2:] = False
    masks[4][-3:] = False
    for size, mask in masks.items():
        at = np.flatnonzero(mask)
        gram = code[at] & np.uint32((1 << 8 * size) - 1) if size < 4 else code[at]
        where.append(at)
        bucket.append(((gram * _SPREAD[size]) >> np.uint32(16)).astype(np.int64))
        weight.append(np.ones(len(at), np.float32))
    begin = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if len(begin):
        end = np.flatnonzero(~space & s1) + 1
        power, inverse = _power_tables(n + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)))
            word = (total[end] - total[begin]) * inverse[begin]
            hashed = (word * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)
        block = np.searchsorted(starts, begin, side="right")
        same = np.zeros(len(begin), bool)
        same[1:] = (word[1:] == word[:-1]) & (block[1:] == block[:-1])
        where += [begin, begin]
        bucket += [hashed.astype(np.int64), np.where(same, REPEAT, FRESH)]
        weight += [np.full(len(begin), WORD_WEIGHT, np.float32)] * 2
    return np.concatenate(where), np.concatenate(bucket), np.concatenate(weight)


def _blocks(text: bytes) -> list[bytes]:
    """Pieces of about CHUNK_BYTES, cut at a space where there is one near the end."""
    out = []
    while len(text) > CHUNK_BYTES:
        cut = text.rfind(b" ", CHUNK_BYTES // 2, CHUNK_BYTES)
        cut = CHUNK_BYTES if cut < 0 else cut
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text]


@dataclass(frozen=True)
class QualityModel:
    """One number per bucket, and a bias."""

    value: np.ndarray
    bias: float

    def scores(self, texts) -> np.ndarray:
        """Probability of label 1 for each text (bytes or None); texts without features get the bias."""
        total, weight = [], []
        queue: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if not queue:
                return
            lengths = np.array([len(b) + 2 for _, b in queue])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            data = np.frombuffer(b"".join(b" " + b + b" " for _, b in queue), np.uint8)
            at, bucket, w = features(data, starts)
            home = np.searchsorted(starts, at, side="right") - 1
            sums = np.bincount(home, self.value[bucket] * w, len(queue))
            weights = np.bincount(home, w, len(queue))
            for (doc, _), a, b in zip(queue, sums, weights, strict=True):
                total[doc] += a
                weight[doc] += b
            queue.clear()
            size = 0

        for text in texts:
            total.append(0.0)
            weight.append(0.0)
            for piece in _blocks(text or b""):
                queue.append((len(total) - 1, piece))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    flush()
        flush()
        logit = np.array(total) / np.maximum(np.array(weight), 1.0) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -700, 700)))

    def score(self, text: Column) -> Column:
        """Column of scores for a text column."""

        @F.arrow_udf("double")
        def quality(array: pa.Array) -> pa.Array:
            return pa.array(self.scores(encoded(array)), pa.float64())

        return quality(text)


def vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and their shares of its weight: at most one entry a bucket, however long the text."""
    mass = np.zeros(BUCKETS + 2)
    for piece in _blocks(text):
        _, bucket, weight = features(np.frombuffer(b" " + piece + b" ", np.uint8), np.zeros(1, int))
        mass += np.bincount(bucket, weight, BUCKETS + 2)
    kinds = np.flatnonzero(mass)
    return kinds, (mass[kinds] / max(mass.sum(), 1.0)).astype(np.float32)


def train(rows: list[tuple[str, int]], share: float = 0.5, epochs: int = 12, batch: int = 32, rate: float = 0.3, seed: int = 7) -> QualityModel:
    """:func:`train_vectors` on (text, label)."""
    return train_vectors([vector(t.encode()) for t, _ in rows], np.array([y for _, y in rows], int), share, epochs, batch, rate, seed)


def train_vectors(
    docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float = 0.5, epochs: int = 12, batch: int = 32, rate: float = 0.3, seed: int = 7
) -> QualityModel:
    """Fit on (buckets, shares) and labels; the bias is moved from the sample's to the corpus' ``share`` of label 1.

    With one class or no rows the model returns a smoothed share of label 1 for every text.
    """
    rng = np.random.default_rng(seed)
    if len(set(labels)) < 2:
        share = (int(labels.sum()) + 1) / (len(labels) + 2)
        return QualityModel(np.zeros(BUCKETS + 2, np.float32), float(np.log(share / (1 - share))))
    table = rng.normal(0, 0.1, (BUCKETS + 2, DIM)).astype(np.float32)
    seen = np.full((BUCKETS + 2, 1), 1e-8, np.float32)
    out = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias, seen_out = np.zeros(2, np.float32), 1e-8
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for low in range(0, len(order), batch):
            part = order[low : low + batch]
            sizes = [len(docs[i][0]) for i in part]
            kinds = np.concatenate([docs[i][0] for i in part])
            mass = np.concatenate([docs[i][1] for i in part])
            cut = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            hidden = np.add.reduceat(table[kinds] * mass[:, None], cut, axis=0)
            logits = hidden @ out + bias
            logits -= logits.max(1, keepdims=True)
            soft = np.exp(logits)
            soft /= soft.sum(1, keepdims=True)
            soft[np.arange(len(part)), labels[part]] -= 1
            soft /= len(part)
            back = soft @ out.T
            flat = np.repeat(back, sizes, axis=0) * mass[:, None]
            rows_hit, inverse = np.unique(kinds, return_inverse=True)
            grad = np.stack([np.bincount(inverse, flat[:, d]) for d in range(DIM)], 1).astype(np.float32)
            seen[rows_hit] += (grad**2).mean(1, keepdims=True)
            table[rows_hit] -= rate * grad / np.sqrt(seen[rows_hit])
            grad_out, grad_bias = hidden.T @ soft, soft.sum(0)
            seen_out += float((grad_out**2).mean())
            out -= rate * grad_out / np.sqrt(seen_out)
            bias -= rate * grad_bias
    prior = np.log(share / (1 - share)) - np.log(labels.mean() / (1 - labels.mean())) if 0 < share < 1 else 0.0
    return QualityModel((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0] + prior))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> QualityModel:
    """Learn ``quality`` from labelled rows outside the held-out fold (crc32 of the id).

    Tasks turn the whole texts of the sampled rows into sparse vectors; only these come to the driver.
    """
    rows, share = labelled_rows(docs, labels, "quality", fold(F.col("doc_id"), folds) != held, TRAIN_ROWS)

    @F.arrow_udf("struct<kinds:array<int>,mass:array<float>>")
    def vectors(array: pa.Array) -> pa.Array:
        found = [vector(text) for text in encoded(array)]
        ends = pa.array(np.cumsum([0, *(len(k) for k, _ in found)]), pa.int32())
        flat = [np.concatenate([f[k] for f in found]) if found else np.empty(0) for k in (0, 1)]
        lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in zip(flat, (pa.int32(), pa.float32()))]
        return pa.StructArray.from_arrays(lists, ["kinds", "mass"])

    found = staged(rows.select("doc_id", "_label", vectors("text").alias("v")).select("doc_id", "_label", "v.*"), "quality-vectors")
    # Share by share, so that the driver's JVM passes on a few megabytes at a time and Python holds the vectors once.
    share_of = F.pmod(F.xxhash64("doc_id"), F.lit(FETCHES))
    seen = pa.concat_tables([found.where(share_of == i).toArrow() for i in range(FETCHES)])
    discard(found)
    order = pc.sort_indices(seen, [("doc_id", "ascending")]).to_numpy()
    kinds, mass = [[x.values.to_numpy() for x in seen[c]] for c in ("kinds", "mass")]
    model = train_vectors([(kinds[i], mass[i]) for i in order], seen["_label"].to_numpy()[order], share)
    del seen, kinds, mass
    pa.default_memory_pool().release_unused()
    return model


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs(doc_id, text)``.

    Null and empty texts get the model's bias as score. Repeated rows are scored alike; other
    columns are ignored. One pass, no shuffle.
    """
    scored = docs.select("doc_id", model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
