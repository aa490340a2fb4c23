"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector, and
the vectors are summed lane by lane modulo powers of two:

- EQUAL_LANES lanes of 32 bits, taken from XXH64 of the paragraph's SHA-256 digest: equal multisets
  have equal sums, whatever the order, and different ones differ but for negligible chance;
- 64 lanes of 31 bits that count, over the paragraph's clauses, which bits of the clause's XXH64 are
  set, and the number of clauses. Centred on half that number these lanes are a random projection
  of the clause counts, so the cosine of two fingerprints estimates how alike two texts are.

Sums can be updated without the text: ``insert`` adds paragraphs, ``delete`` takes them away, and
the fingerprint of "a newline b" is that of a plus that of b. Everything is an array function on the
row: no text is exploded, and no shuffle is needed to fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EQUAL_LANES, LIKE_BITS = 12, 32
EQUAL_MOD, LIKE_MOD = 1 << 32, 1 << 31
_PAIR = (1 << 32) | 1
# Documents between two boundaries of the order, and most boundaries.
RANGE_ROWS, MAX_RANGES = 1000, 1 << 16


def paragraphs(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` bound to a variable: an inner lambda would compute it on every call."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def equal_lanes(lines: Column) -> Column:
    """Sums modulo 2^32 of EQUAL_LANES hashes of each paragraph."""
    digests = F.transform(lines, lambda p: F.sha2(p.cast("binary"), 256))
    total = lambda ds, i: F.aggregate(ds, F.lit(0).cast("long"), lambda a, d: a + _and(F.xxhash64(d, i), EQUAL_MOD - 1))
    lanes = F.sequence(F.lit(1), F.lit(EQUAL_LANES))
    return _once(digests, lambda ds: F.transform(lanes, lambda i: F.pmod(total(ds, i), F.lit(EQUAL_MOD))))


def _and(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask))


def clauses(text: Column) -> Column:
    """Runs between line ends, full stops and commas; empty ones are left out. Plain signs split faster than patterns."""
    sentences = F.flatten(F.transform(paragraphs(text), lambda p: F.split(p, r"\.", -1)))
    return F.filter(F.flatten(F.transform(sentences, lambda s: F.split(s, ",", -1))), lambda c: c != "")


def like_lanes(parts: Column) -> Column:
    """Number of clauses, then LIKE_BITS longs that each hold two bit counts (low and high 32 bits)."""
    hashes = F.transform(parts, lambda c: F.xxhash64(c))
    bits = F.sequence(F.lit(0), F.lit(LIKE_BITS - 1))
    total = lambda hs, g: F.aggregate(hs, F.lit(0).cast("long"), lambda a, h: a + _and(F.call_function("shiftrightunsigned", h, g), _PAIR))
    counted = lambda hs: F.concat(F.array(F.size(hs).cast("long")), F.transform(bits, lambda g: total(hs, g)))
    return _once(hashes, counted)


def lanes(text: Column) -> Column:
    """The vector of a text: equality lanes, clause count, paired bit counts."""
    return F.concat(equal_lanes(paragraphs(text)), like_lanes(clauses(text)))


def _modulo(i: Column) -> Column:
    return F.when(i < EQUAL_LANES, F.lit(EQUAL_MOD)).otherwise(F.lit(1 << 62))


def insert(vector: Column, other: Column) -> Column:
    """Vector after adding the paragraphs of another vector."""
    summed = F.zip_with(vector, other, lambda a, b: a + b)
    return F.transform(summed, lambda x, i: F.pmod(x, _modulo(i)))


def delete(vector: Column, other: Column) -> Column:
    """Vector after taking away the paragraphs of another vector."""
    less = F.zip_with(vector, other, lambda a, b: a - b)
    return F.transform(less, lambda x, i: F.pmod(x, _modulo(i)))


def hexadecimal(vector: Column) -> Column:
    """The vector as text: 8 hex digits for each equality lane, 16 for the others."""
    return F.lower(F.array_join(F.transform(vector, lambda x, i: F.lpad(F.hex(x), F.when(i < EQUAL_LANES, 8).otherwise(16), "0")), ""))


def centred(vector: Column) -> Column:
    """64 lanes: set bits minus unset bits over all clauses."""
    n = F.element_at(vector, EQUAL_LANES + 1)
    pairs = F.slice(vector, EQUAL_LANES + 2, LIKE_BITS)
    low = F.transform(pairs, lambda x: _and(x, 0xFFFFFFFF) * 2 - n)
    high = F.transform(pairs, lambda x: F.shiftright(x, 32) * 2 - n)
    return F.concat(low, high)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def likeness(vector: Column, other: Column, signs: Column, other_signs: Column) -> Column:
    """1 for equal multisets, else the cosine of the centred lanes, at least 0 (0 if either has none)."""
    norm = F.sqrt(_dot(signs, signs) * _dot(other_signs, other_signs))
    cosine = F.when(norm > 0, _dot(signs, other_signs) / norm).otherwise(0.0)
    equal = F.slice(vector, 1, EQUAL_LANES) == F.slice(other, 1, EQUAL_LANES)
    return F.when(equal, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def with_next(docs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, vector, next_text, next_vector: each document with the one after it in descending doc_id, the last with the first.

    Equal ids are ordered by text, null ids come last. Boundaries are ids from the table at equal
    ranks, so ranges hold about ``rows`` documents however ids are spread; texts are shuffled once,
    by range. The first document of a range (its id is the boundary) is also sent to the range
    before it, so that no range needs to know its neighbour.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lanes(F.col("text")).alias("vector"))
    n = docs.count()
    ranges = min(MAX_RANGES, max(1, n // rows))
    found = docs.agg(
        F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges + 1)], max(10_000, 4 * ranges)).alias("b"),
        F.max("doc_id").alias("top"),
    ).first()
    bounds = sorted({*(found.b or []), *([found.top] if found.top is not None else [])})
    if not bounds:  # no document has an id
        bounds = [0]
    # Range k holds ids above bounds[k - 1] and up to bounds[k]; null ids go to range 0, after all others.
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    tops = F.array(*[F.lit(g[-1]) for g in groups])
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    inner = F.array(*[longs(g) for g in groups])
    doc = F.coalesce("doc_id", F.lit(bounds[0]))
    group = F.size(F.filter(tops, lambda b: b < doc))
    home = group * width + F.size(F.filter(F.get(inner, group), lambda b: b < doc))
    last = len(bounds) - 1
    placed = texts.withColumn("home", home)
    is_first = (F.col("doc_id") == F.get(F.get(inner, F.floor(F.col("home") / width).cast("int")), F.pmod(F.col("home"), F.lit(width)).cast("int")))
    if found.top is None:
        is_first = F.lit(True)
    ahead = F.when(F.col("home") == last, F.lit(0)).otherwise(F.col("home") + 1)
    homes = F.when(F.coalesce(is_first, F.lit(False)), F.array(F.struct(F.col("home").alias("range"), F.lit(0).alias("guest")), F.struct(ahead.alias("range"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("home").alias("range"), F.lit(0).alias("guest")))
    )
    sent = placed.select("doc_id", "text", "vector", F.explode(homes).alias("h")).select("doc_id", "text", "vector", "h.*")
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    after = sent.withColumns({"next_text": F.lead("text").over(order), "next_vector": F.lead("vector").over(order)})
    return after.where("guest = 0").select("doc_id", "text", "vector", "next_text", "next_vector")


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, vector of every row of ``docs(doc_id, text)``; null counts as empty. No shuffle."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), lanes(F.col("text")).alias("vector"))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last third replaced by the head of the next document (see
    ``with_next``). Null and empty texts are alike: fingerprint of one empty line, n_chars 0,
    edited text empty. Repeated rows are compared with each other as they follow in order; a
    single document is its own next. Other columns are ignored.
    """
    paired = with_next(docs)
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    texts = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    summed = texts.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("vector").alias("v"),
        lanes(F.col("edited")).alias("e"),
        F.col("next_vector").alias("x"),
    )
    signed = summed.withColumns({"vs": centred(F.col("v")), "es": centred(F.col("e")), "xs": centred(F.col("x"))})
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("v")).alias("fingerprint"),
        hexadecimal(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("e"), F.col("vs"), F.col("es")).alias("near_edited"),
        likeness(F.col("v"), F.col("x"), F.col("vs"), F.col("xs")).alias("near_next"),
    )
