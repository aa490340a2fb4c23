"""Toxicity: maximum-scoring segments over token log-odds, calibrated by extreme values.

Tokens are lower-cased words. A word's score is its log-odds between toxic and clean documents
under an informative Dirichlet prior (the background frequencies); a word too rare to judge takes
the score of its longest known prefix of 6 to 4 letters. Words that are not significantly toxic
cost a fixed amount, so a random text drifts down. One linear scan finds all maximal-scoring
segments, i.e. every toxic passage. Under the clean background the best score of n words follows
an extreme-value law, P(S >= s) = 1 - exp(-K n e^(-lambda s)); with lambda from that background,
each segment gets a score in nats beyond chance, and the best and the summed significant ones are
turned into a probability by a logistic curve fitted on the sample.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, sample_ids, staged

# Sample bound of the fit (rows per label, whole texts) and largest lexicon.
TRAIN_ROWS, LEXICON = 4000, 20_000
# Dirichlet prior: background frequencies worth this many tokens, and a floor for every token.
PRIOR_TOKENS, PRIOR_FLOOR = 500.0, 0.5
SIGNIFICANT_Z = 2.5
# Share of toxic words expected inside a toxic passage; sets the cost of other words.
PASSAGE_SHARE = 0.2
PREFIXES = (6, 5, 4)
WORD = re.compile(r"[^\W_]+")


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first position, last position, score), in one linear scan.

    ``hits`` are (position, positive score) in order; every other position costs ``cost``.
    """
    out: list[tuple[int, int, float, float]] = []  # first, last, sum before it, sum up to it
    lower: list[int] = []  # of each: the latest earlier segment with a smaller sum before it, or -1
    total, last = 0.0, -1
    for at, score in hits:
        total -= cost * (at - last - 1)
        new = (at, at, total, total + score)
        total, last = total + score, at
        j = len(out) - 1
        while True:
            # Segments between one and its ``lower`` start no lower than it does, so they are skipped
            # for good.
            while j >= 0 and out[j][2] >= new[2]:
                j = lower[j]
            if j < 0 or out[j][3] >= new[3]:
                out.append(new)
                lower.append(j)
                break
            new = (out[j][0], new[1], out[j][2], new[3])
            up = lower[j]
            del out[j:], lower[j:]
            j = up
    return [(first, end, high - low) for first, end, low, high in out]


@dataclass(frozen=True)
class ToxicityModel:
    """Token scores, background law and calibration."""

    words: dict[str, float]
    cost: float
    rate: float  # lambda
    constant: float  # K
    curve: tuple[float, float, float]  # of best, summed, bias
    heads: frozenset = field(default=frozenset())

    def score_of(self, word: str) -> float | None:
        found = self.words.get(word)
        if found is None:
            for size in PREFIXES:
                if len(word) > size and (found := self.words.get(word[:size] + "*")) is not None:
                    return found
        return found

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and (first word, last word, nats beyond chance) of each toxic segment."""
        words = WORD.findall(text.lower()) if text else []
        heads = self.heads
        hits = [
            (i, score) for i, w in enumerate(words) if w[:4] in heads and (score := self.score_of(w)) is not None
        ]
        if not hits:
            return len(words), []
        chance = math.log(self.constant * len(words))
        return len(words), [(a, b, self.rate * s - chance) for a, b, s in segments(hits, self.cost)]

    def evidence(self, text: str | None) -> tuple[float, float]:
        """Best segment and log of the summed significant ones, in nats; zeros without any."""
        found = [s for _, _, s in self.passages(text)[1]]
        return (max(found), math.log1p(sum(s for s in found if s > 0))) if found else (0.0, 0.0)

    def probability(self, text: str | None) -> float:
        a, b, bias = self.curve
        best, summed = self.evidence(text)
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, a * best + b * summed + bias))))

    def score(self, text: Column) -> Column:
        """Column of scores for a text column."""

        @F.arrow_udf("double")
        def toxicity(array: pa.Array) -> pa.Array:
            return pa.array([self.probability(v.as_py()) for v in array], pa.float64())

        return toxicity(text)

    def passages_of(self, text: Column) -> Column:
        """Column of every significant passage: first and last word, nats beyond chance."""

        @F.arrow_udf("array<struct<first:int,last:int,nats:double>>")
        def spans(array: pa.Array) -> pa.Array:
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("nats", pa.float64())]))
            rows = [
                [{"first": a, "last": b, "nats": s} for a, b, s in self.passages(v.as_py())[1] if s > 0] for v in array
            ]
            return pa.array(rows, kind)

        return spans(text)


def background_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive lambda with sum(shares * exp(lambda * scores)) = 1; needs a negative mean."""
    low, high = 1e-6, 1.0
    total = lambda x: float((shares * np.exp(x * scores)).sum())
    while total(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 1 else (low, mid)
    return low


def build(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> ToxicityModel:
    """Model without calibration from (token, toxic count, clean count) and the totals of all tokens."""
    cost = -math.log(1 - PASSAGE_SHARE)
    if not counts or not toxic or not clean:
        return ToxicityModel({}, cost, 1.0, 1.0, (0.0, 0.0, 0.0))
    token = [c[0] for c in counts]
    t, c = (np.array([x[k] for x in counts], float) for k in (1, 2))
    prior = PRIOR_TOKENS * (t + c) / (toxic + clean) + PRIOR_FLOOR
    odds_t = (t + prior) / (toxic + PRIOR_TOKENS - t - prior)
    odds_c = (c + prior) / (clean + PRIOR_TOKENS - c - prior)
    delta = np.log(odds_t) - np.log(odds_c)
    z = delta / np.sqrt(1 / (t + prior) + 1 / (c + prior))
    keep = np.flatnonzero((z >= SIGNIFICANT_Z) & (delta > 0))
    keep = keep[np.argsort(-z[keep], kind="stable")][:LEXICON]
    words = {token[i]: float(delta[i]) for i in keep}
    whole = [i for i in keep if not token[i].endswith("*")]
    shares = (c[whole] + prior[whole]) / (clean + PRIOR_TOKENS)
    scores = np.append(delta[whole], -cost)
    shares = np.append(shares, max(1 - shares.sum(), 1e-9))
    drift = float((scores * shares).sum())
    rate = background_rate(scores, shares / shares.sum()) if drift < 0 else 0.1
    constant = min(1.0, max(1e-3, rate * abs(drift)))
    return ToxicityModel(words, cost, rate, constant, (0.0, 0.0, 0.0), frozenset(w.rstrip("*")[:4] for w in words))


def calibrate(evidence: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float, float]:
    """Logistic curve through the sample's evidence, its bias moved to the corpus' share of label 1."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return 0.0, 0.0, math.log(share / (1 - share))
    x = np.column_stack([evidence, np.ones(len(evidence))])
    w = np.zeros(3)
    ridge = np.diag([1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    if 0 < share < 1:
        w[2] += math.log(share / (1 - share)) - math.log(labels.mean() / (1 - labels.mean()))
    return float(w[0]), float(w[1]), float(w[2])


def _prefixes(words: Column, n: int) -> Column:
    """Marked heads of ``n`` letters of the longer words."""
    return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def token_counts(sample: DataFrame) -> DataFrame:
    """(half, token, toxic, clean): documents of ``sample(text, _label, half)`` with each word or marked prefix."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    marked = [_prefixes(words, n) for n in PREFIXES]
    tokens = sample.select("_label", "half", F.explode(F.array_distinct(F.concat(words, *marked))).alias("token"))
    return tokens.groupBy("half", "token").agg(F.sum("_label").alias("toxic"), F.sum(1 - F.col("_label")).alias("clean"))


# Log-odds that a token needs besides: a rate among toxic documents e times that among clean ones.
LEAST_ODDS = 1.0


def learn_tokens(counted: DataFrame) -> ToxicityModel:
    """Uncalibrated model from ``counted(token, toxic, clean)``; at most four times LEXICON rows are collected.

    Tokens compete by the score that :func:`build` gives them, so neither the size of the sample nor its
    share of toxic rows changes which kind of token is kept.
    """
    toxic, clean = (x or 0 for x in counted.agg(F.sum("toxic"), F.sum("clean")).first())
    tokens = counted.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    prior = (t + c) * (PRIOR_TOKENS / max(1, toxic + clean)) + PRIOR_FLOOR
    delta = F.log((t + prior) / (toxic + PRIOR_TOKENS - t - prior)) - F.log((c + prior) / (clean + PRIOR_TOKENS - c - prior))
    scored = tokens.where("toxic >= 3").withColumn("z", delta / F.sqrt(1 / (t + prior) + 1 / (c + prior)))
    kept = scored.withColumn("delta", delta).where((F.col("z") >= SIGNIFICANT_Z) & (F.col("delta") >= LEAST_ODDS)).orderBy(F.desc("z"), "token").limit(4 * LEXICON)
    return build([tuple(r) for r in kept.select("token", "toxic", "clean").collect()], toxic, clean)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> ToxicityModel:
    """Learn ``toxic`` from labelled rows outside the held-out fold (crc32 of the id).

    The sample's ids are broadcast (at most two times TRAIN_ROWS); its words are counted by Spark,
    and only tokens in at least three toxic documents, at most four times LEXICON of them, come
    to the driver. The calibration looks at one half of the sample with tokens learned from the
    other; the model's own tokens come from both.
    """
    ids, share = sample_ids(labels, "toxic", fold(F.col("doc_id"), folds) != held, TRAIN_ROWS)
    sample = staged(
        docs.select("doc_id", "text")
        .where("text is not null")
        .join(F.broadcast(ids), "doc_id")
        .select("text", "_label", (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0).alias("half")),
        "toxic-sample",
    )
    counted = staged(token_counts(sample), "toxic-tokens")
    half, model = learn_tokens(counted.where("half")), learn_tokens(counted)

    @F.arrow_udf("struct<best:double,summed:double>")
    def evidence(array: pa.Array) -> pa.Array:
        rows = [half.evidence(v.as_py()) for v in array]
        return pa.array([{"best": a, "summed": b} for a, b in rows], pa.struct([("best", pa.float64()), ("summed", pa.float64())]))

    seen = sample.where("not half").select(evidence("text").alias("e"), "_label")
    rows = sorted(tuple(r) for r in seen.select("e.best", "e.summed", "_label").collect())
    points = np.array(rows, float).reshape(-1, 3)
    return replace(model, curve=calibrate(points[:, :2], points[:, 2], share))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs(doc_id, text)``.

    Null, empty and wordless texts get the curve's bias as score. Repeated rows are scored alike;
    other columns are ignored. One pass, no shuffle.
    """
    scored = docs.select("doc_id", model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
