"""Language identification: a convolutional network on bytes, trained in numpy.

A text is cut into fixed-length windows of bytes. Filters of widths 2, 3 and 4 slide over a
window; each filter's best response is kept (max pooling) and a softmax layer turns these into
language probabilities. A document's prediction averages the log-probabilities of all its
windows by their length.

A first layer on one-hot bytes is a sum of table rows, so pairs of bytes are looked up in
prepared tables; the whole text is scored in vectorised batches of windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import encoded, fold, staged

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
BATCH = 512
# Sample bound of the fit: rows per language. Windows of each that an epoch draws.
TRAIN_ROWS, DRAWS = 600, 2
UNKNOWN = "und"


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows (zero padded) of the texts, the text each belongs to, and its length in bytes."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], int)
    home = np.repeat(np.arange(len(texts)), counts)
    data = np.frombuffer(b"".join(t + b"\0" * (-len(t) % WINDOW) for t in texts), np.uint8).reshape(-1, WINDOW)
    lengths = np.full(len(home), WINDOW)
    last = np.cumsum(counts)[counts > 0] - 1
    sizes = np.array([len(t) for t in texts], int)[counts > 0]
    lengths[last] = sizes - (counts[counts > 0] - 1) * WINDOW
    return data, home, lengths


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    kernels: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        k = self.kernels
        return [pair(k[2][0], k[2][1]), pair(k[3][0], k[3][1]), k[3][2], pair(k[4][0], k[4][1]), pair(k[4][2], k[4][3])]

    def pooled(self, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """(windows, filters): best response of each filter."""
        codes = data[:, :-1].astype(np.int32) * 256 + data[:, 1:]
        two = tables[0][codes].max(1)
        three = (tables[1][codes[:, :-1]] + tables[2][data[:, 2:]]).max(1)
        four = (tables[3][codes[:, :-2]] + tables[4][codes[:, 2:]]).max(1)
        return np.concatenate([two, three, four], 1) + self.bias

    def logs(self, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        logit = np.tanh(self.pooled(data, tables)) @ self.out + self.out_bias
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True))

    def predict(self, texts, tables: list[np.ndarray] | None = None) -> tuple[list[str], list[float]]:
        """Language and probability for each text; None gives ``und`` and 0.

        At most about BATCH windows are in work at once, however long a text is.
        """
        tables = tables or self.tables()
        sums: list[np.ndarray | None] = []
        sizes: list[int] = []
        queue: list[tuple[int, bytes]] = []
        waiting = 0

        def flush() -> None:
            nonlocal waiting
            if queue:
                data, home, length = windows([t for _, t in queue])
                logs = self.logs(data, tables) * length[:, None]
                for k, (doc, _) in enumerate(queue):
                    low, high = np.searchsorted(home, (k, k + 1))
                    sums[doc] = sums[doc] + logs[low:high].sum(0)
                queue.clear()
                waiting = 0

        for text in texts:
            sums.append(None if text is None else np.zeros(len(self.languages)))
            sizes.append(len(text or b""))
            if text is None or not self.languages:
                continue
            text = text.lower()
            for low in range(0, len(text), BATCH * WINDOW):
                queue.append((len(sums) - 1, text[low : low + BATCH * WINDOW]))
                waiting += -(-len(queue[-1][1]) // WINDOW)
                if waiting >= BATCH:
                    flush()
        flush()
        names, scores = [], []
        for total, size in zip(sums, sizes, strict=True):
            if total is None or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            mean = total / max(size, 1)
            p = np.exp(mean - mean.max())
            p /= p.sum()
            names.append(self.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores

    def column(self, text: Column) -> Column:
        """Struct column (lang, score); text must be null where there is no letter."""

        @F.arrow_udf("struct<lang:string,score:double>")
        def language(array: pa.Array) -> pa.Array:
            names, scores = self.predict(encoded(array))
            return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

        return language(text)


def train(rows: list[tuple[str, str]], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> LanguageModel:
    """Fit on (text, language) with Adam. Every epoch draws ``DRAWS`` windows of each whole text, or all if it has fewer."""
    rng = np.random.default_rng(seed)
    languages = sorted({y for _, y in rows})
    place = {y: i for i, y in enumerate(languages)}
    texts = [t.encode().lower() for t, _ in rows]
    n = len(WIDTHS) * FILTERS
    p = {w: rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(n, np.float32), "out": rng.normal(0, 0.3, (n, len(languages))).astype(np.float32), "out_bias": np.zeros(len(languages), np.float32)}
    if not languages or not any(texts):
        return LanguageModel(languages, {w: p[w] for w in WIDTHS}, p["bias"], p["out"], p["out_bias"])
    data, home, _ = windows(texts)
    labels = np.array([place[y] for _, y in rows])[home]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        # Windows in random order within their text; the first few of each, in random order.
        mixed = np.lexsort((rng.random(len(data)), home))
        begin = np.searchsorted(home, home[mixed])
        drawn = mixed[np.arange(len(data)) - begin < DRAWS]
        order = rng.permutation(drawn)
        for low in range(0, len(order), batch):
            part = order[low : low + batch]
            x, rows_at = data[part], np.arange(len(part))
            pooled, best = [], []
            for w in WIDTHS:
                response = sum(p[w][k][x[:, k : WINDOW - w + 1 + k]] for k in range(w))
                top = response.argmax(1)
                best.append(top)
                pooled.append(np.take_along_axis(response, top[:, None, :], 1)[:, 0])
            hidden = np.tanh(np.concatenate(pooled, 1) + p["bias"])
            logit = hidden @ p["out"] + p["out_bias"]
            soft = np.exp(logit - logit.max(1, keepdims=True))
            soft /= soft.sum(1, keepdims=True)
            soft[rows_at, labels[part]] -= 1
            soft /= len(part)
            back = (soft @ p["out"].T) * (1 - hidden**2)
            grad = {"out": hidden.T @ soft, "out_bias": soft.sum(0), "bias": back.sum(0)}
            for j, w in enumerate(WIDTHS):
                grad[w] = np.zeros_like(p[w])
                own = back[:, j * FILTERS : (j + 1) * FILTERS]
                for k in range(w):
                    np.add.at(grad[w][k], (x[rows_at[:, None], best[j] + k], np.arange(FILTERS)[None, :]), own)
            step += 1
            for key, g in grad.items():
                first[key] = 0.9 * first[key] + 0.1 * g
                second[key] = 0.999 * second[key] + 0.001 * g * g
                p[key] = p[key] - rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.999**step)) + 1e-8)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    return LanguageModel(languages, {w: p[w] for w in WIDTHS}, p["bias"], p["out"], p["out_bias"])


def sample(docs: DataFrame, folds: int = 5, held: int = 0) -> list[tuple[str, str]]:
    """Bounded sample (text, lang) outside the held-out fold: whole texts of ``TRAIN_ROWS`` rows of every language.

    Per language the rows of smallest id hash; ranks are cut inside each task before any shuffle. Of
    rows that share an id and a language, one is taken.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held)
    )
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    narrow = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # Repeated rows share a rank, so that no id crowds out another.
    ranked = narrow.withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= TRAIN_ROWS)
    ids = staged(ranked.select("doc_id", "lang").distinct(), "language-ids")
    rows = known.join(ids, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("t"))
    return [(r.t, r.lang) for r in sorted(rows.collect(), key=lambda r: (r.lang, r.doc_id))]


def fit(docs: DataFrame, folds: int = 5, held: int = 0) -> LanguageModel:
    """Learn the languages of ``docs(doc_id, text, lang)`` outside the held-out fold."""
    return train(sample(docs, folds, held))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs(doc_id, text)``.

    ``und`` with score 0 where the text is null or has no letter, or if no language was learned.
    Repeated rows are predicted alike; other columns are ignored. One pass, no shuffle.
    """
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    found = docs.select("doc_id", model.column(lettered).alias("l"))
    return found.select("doc_id", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))
