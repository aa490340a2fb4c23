"""Date and time mentions: the scan grammar and the meaning of one mention.

A mention becomes an operation ``struct<op, a, b, grain>``:

- ``set``   absolute interval, a = start, b = end (epoch seconds, last second included)
- ``fix``   day and month of the reference year, a = month, b = day
- ``shift`` reference moved by a units of ``grain``
- ``clock`` time on the reference day, a = seconds after midnight
- ``fail``  no date
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import DAY, days_in_month, epoch

MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]
# Every spelling of a month stands at its number modulo twelve.
_NAMES = MONTHS + [m[:3] for m in MONTHS] + ["Sept" if m == "September" else m[:3] for m in MONTHS]
_MONTH = (
    "(Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?"
    "|Nov(?:ember)?|Dec(?:ember)?)"
)
_UNIT = "(?:minute|hour|day|week|month|year)"
_ERA = "(?:BC|AD)"
_ORDINAL = "(?:st|nd|rd|th)"
_YEAR = r"(?:1\d{3}|20\d{2})"

# At one position the first alternative that fits is taken, so longer forms come first. Years below
# 1000 and above 2099 need an era; numbers too large for the calendar give failed mentions, not none.
GRAMMAR = [
    rf"\d{{1,2}}-\d{{1,2}} {_MONTH} \d{{4}}",
    rf"{_MONTH}(?: to |-){_MONTH} \d{{4}}",
    rf"\d{{1,2}}{_ORDINAL}(?: of)? {_MONTH}(?: \d{{4}})?",
    rf"{_MONTH} \d{{1,2}}{_ORDINAL}(?:, \d{{4}})?",
    rf"{_YEAR}/\d{{2}}",
    r"(?:[Ee]arly |[Ll]ate |[Mm]id[ -])\d+0s",
    r"\d{1,2}(?::\d{2})? [ap]m",
    rf"\d{{1,2}} {_MONTH}(?: \d+ {_ERA}| \d{{4}})?",
    rf"{_MONTH}(?: \d{{1,2}}, (?:\d+ {_ERA}|\d{{4}})| \d+ {_ERA}| \d{{4}}| \d{{1,2}})",
    r"\d{4}-\d{2}-\d{2}",
    rf"{_YEAR}-{_YEAR}",
    rf"\d+ {_ERA}",
    r"AD \d+",
    r"\d{1,2}(?:st|nd|rd|th) century(?: BC)?",
    r"\d+0s",
    rf"\d+ {_UNIT}s? (?:later|earlier)",
    r"[Tt]he (?:following|next|previous) (?:day|week|month|year)",
    r"\d{1,2}:\d{2}",
    _YEAR,
]



def _scan() -> str:
    """One pattern for all forms. Each lookahead names the first characters of its forms, and no character is among those
    of two, so a position is held against few forms and their order is that of the grammar."""
    months = [form for form in GRAMMAR if form.startswith(_MONTH)]
    digits = [form for form in GRAMMAR if form.startswith((r"\d", _YEAR))]
    words = [form for form in GRAMMAR if form not in months and form not in digits]
    kinds = [rf"(?=\d)(?:{'|'.join(digits)})", rf"(?=[JFMASOND])(?:{'|'.join(months)})", rf"(?=[ATtEeLlMm])(?:{'|'.join(words)})"]
    return r"\b(?:" + "|".join(kinds).replace(_MONTH, "(?:" + _MONTH[1:]) + r")\b"


SCAN = _scan()
# Every form holds a digit at its start or after a space or mark, but for one that starts with these words.
HINT = r"\b\d|[Tt]he (?:following|next|previous) "


# White space after the end of a sentence.
SENTENCE_GAP = r"(?<=[.!?])\s+"
# Lengths summed in one go; longer lists are summed in runs of this size.
_RUN = 256
# Characters of texts with few enough hits to fold them into one list and to look around each.
_SHORT = 2000


def _starts(lengths: Column) -> Column:
    """Sum of the lengths before each one. Lists grow in runs, so long ones are not copied for every item."""
    zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def step(acc, n):
        return F.struct((acc["sum"] + n).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out"))

    def runs(own):
        count = F.ceil(F.size(own) / _RUN).cast("int")
        parts = F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda i: F.aggregate(F.slice(own, (i - 1) * _RUN + 1, F.lit(_RUN)), zero, step),
        )
        return F.transform(F.array(parts), shifted)[0]

    def shifted(parts):
        begins = F.aggregate(F.transform(parts, lambda p: p["sum"]), zero, step, lambda acc: acc["out"])
        moved = F.zip_with(parts, begins, lambda p, begin: F.transform(p["out"], lambda x: x + begin))
        return F.flatten(moved)

    def summed(own):
        return F.when(F.size(own) <= _RUN, F.aggregate(own, zero, step, lambda acc: acc["out"])).otherwise(runs(own))

    # Bound to a variable each time: an inner function would compute the list again for every call.
    return F.transform(F.array(lengths), summed)[0]


def _cut(text: Column, pattern: str) -> Column:
    """``array<struct<gap, hit>>``: the hits of a pattern and the text before each; last the text after all."""
    # Hits are put between control characters and the text is split there, so the pattern is matched once; a pattern
    # given to split() would be compiled per row. Gaps and hits take turns, and the gap after the last hit pairs with NULL.
    parts = F.split(F.regexp_replace(F.translate(text, "\x01", "\x02"), pattern, "\x01$0\x01"), "\x01", -1)

    def paired(own):
        return F.transform(
            F.sequence(F.lit(0), F.array_size(own) - 1, F.lit(2)),
            lambda i: F.struct(F.get(own, i).alias("gap"), F.get(own, i + 1).alias("hit")),
        )

    return F.transform(F.array(parts), paired)[0]


def _placed(pairs: Column) -> Column:
    """The pairs with the position of each gap."""
    widths = F.transform(pairs, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0)))
    return F.arrays_zip(pairs.alias("pair"), _starts(widths).alias("pos"))


_HITS = "array<struct<date_text:string,start_pos:int,end_pos:int,sentence:string>>"


def _hit(text: Column, begin: Column, sentence: Column) -> Column:
    end = begin + F.length(text)
    return F.struct(text.alias("date_text"), begin.alias("start_pos"), end.alias("end_pos"), sentence.cast("string").alias("sentence"))


def find_mentions(text: Column) -> Column:
    """``array<struct<date_text, start_pos, end_pos, sentence>>`` in reading order, character positions; no
    sentence. The list is copied for each hit: for texts with few of them."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(_HITS).alias("out"))

    def step(acc, pair):
        hit = _hit(pair["hit"], acc["pos"] + F.length(pair["gap"]), F.lit(None))
        longer = F.struct(hit["end_pos"].alias("pos"), F.array_append(acc["out"], hit).alias("out"))
        return F.when(pair["hit"].isNull(), acc).otherwise(longer)

    return F.aggregate(_cut(text, SCAN), start, step, lambda acc: acc["out"])


def _find_many(sentence: Column, shift: Column) -> Column:
    """The same for a sentence that starts at ``shift``, in time that grows with its length however many hits it has."""

    def mentions(pairs):
        hits = F.filter(_placed(pairs), lambda p: p["pair"]["hit"].isNotNull())
        return F.transform(hits, lambda p: _hit(p["pair"]["hit"], shift + p["pos"] + F.length(p["pair"]["gap"]), F.trim(sentence)))

    return F.transform(F.array(_cut(sentence, SCAN)), mentions)[0]


def sentences(text: Column) -> Column:
    """``array<struct<text, pos>>``: the sentences of a text and where each starts. No mention spans two."""

    def listed(sentence):
        return lambda pairs: F.transform(_placed(pairs), lambda p: F.struct(sentence(p).alias("text"), p["pos"].alias("pos")))

    cut = F.array(_cut(text, SENTENCE_GAP))
    as_cut = F.transform(cut, listed(lambda p: p["pair"]["gap"]))[0]
    # Gaps have the marker replaced; a text that holds it is cut out of the original, which takes longer.
    original = F.transform(cut, listed(lambda p: F.substring(text, p["pos"] + 1, F.length(p["pair"]["gap"]))))[0]
    return F.when(text.contains("\x01"), original).otherwise(as_cut)


def sentence_around(text: Column, start_pos: Column, end_pos: Column) -> Column:
    """The sentence that holds ``[start_pos, end_pos)``; looks at the whole text."""
    before = F.regexp_extract(F.substring(text, F.lit(1), start_pos), r"(?s)^(?:.*[.!?]\s+)?(.*)\z", 1)
    mention = F.substring(text, start_pos + 1, end_pos - start_pos)
    after = F.regexp_extract(F.substring(text, end_pos + 1, F.length(text)), r"(?s)^.*?(?=(?<=[.!?])\s|\z)", 0)
    return F.trim(F.concat(before, mention, after))


def find_in_sentences(text: Column) -> Column:
    """``array<struct<date_text, start_pos, end_pos, sentence>>`` in reading order.

    A short text is searched as a whole, and ``sentence`` is NULL: it is looked up around each hit
    (:func:`sentence_around`). A long one is cut into sentences first and each is searched by itself,
    so time grows with the text, however many hits it has.
    """

    dated = F.filter(sentences(text), lambda s: s["text"].rlike(HINT))
    many = F.flatten(F.transform(dated, lambda s: _find_many(s["text"], s["pos"])))
    return F.when(F.length(text) <= _SHORT, find_mentions(text)).otherwise(many)


_RULES = (
    "map<string,struct<op:string,grain:string,sign:int,y:int,scale:int,shift:int,years:int,upto:int,least:bigint,"
    "m:int,d:int,low:bigint,high:bigint,step:int,dto:int,mto:int>>"
)
_BY_NAME = -1
# Years that the calendar can place in 64-bit seconds, and units that a shift may count.
_YEARS, _SHIFTS = 2 * 10**11, 10**9


def _rule(op, grain=None, sign=1, y=None, scale=1, shift=0, years=1, upto=None, least=0, m=None, d=None, low=0, high=_YEARS, step=1, dto=None, mto=None):
    """How the numbers of one form are read. ``y, upto, m, d`` are indexes into them; the year is
    ``number * scale + shift`` of a number of at least ``least``; a form of two years ends with that
    at ``upto``; one of two days with that at ``dto``, one of two months with the named one at ``mto``; the first
    number must be a multiple of ``step`` in ``[low, high]``."""
    return dict(op=op, grain=grain, sign=sign, y=y, scale=scale, shift=shift, years=years, upto=upto, least=least, m=m, d=d, low=low, high=high, step=step, dto=dto, mto=mto)


def _rules() -> dict[str, dict]:
    """Reading rule by shape: the mention with every digit as 9, five or more as 9+, and every month name as M."""
    nines = ["", "9", "99", "999", "9999", "9+"]
    # Unit of a shift: what it is counted in, and how many of those.
    units = {"minute": ("minute", 1), "hour": ("minute", 60), "day": ("day", 1), "week": ("day", 7), "month": ("month", 1), "year": ("year", 1)}
    rules = {
        "M 9999": _rule("set", "month", y=0, m=_BY_NAME),
        "9999-99-99": _rule("set", "day", y=0, m=1, d=2),
        "9999-9999": _rule("set", "year", y=0, upto=1, low=1000, high=2099),
        "9999": _rule("set", "year", y=0, low=1000, high=2099),
    }
    rules["9999/99"] = _rule("set", "year", y=0, upto=1, low=1000, high=2099)
    rules["M to M 9999"] = rules["M-M 9999"] = _rule("set", "month", y=0, m=_BY_NAME, mto=1)
    # Thirds of a decade: its years 0 to 3, 4 to 6 and 7 to 9.
    for word, joint, shift, years in (("early", " ", 0, 4), ("mid", " ", 4, 3), ("mid", "-", 4, 3), ("late", " ", 7, 3)):
        for n in nines[2:]:
            rules[f"{word}{joint}{n}s"] = rules[f"{word.capitalize()}{joint}{n}s"] = _rule("set", "year", y=0, shift=shift, years=years, step=10)
    eras = {"BC": dict(scale=-1, shift=1, least=1), "AD": dict(least=1)}
    for n in nines[1:3]:
        rules[f"{n} M 9999"] = _rule("set", "day", y=1, m=_BY_NAME, d=0)
        rules[f"M {n}, 9999"] = rules[f"{n} M 9999"]
        # Year 2000 has a 29 February; whether the reference year has one, the fold decides.
        rules[f"{n} M"] = rules[f"M {n}"] = _rule("fix", y=0, scale=0, shift=2000, m=_BY_NAME, d=0)
        rules[f"{n}:99"] = _rule("clock", high=23)
        for word, hours in (("am", 0), ("pm", 12)):
            # Scale 12: an hour of half a day, and the hours before that half.
            rules[f"{n} {word}"] = rules[f"{n}:99 {word}"] = _rule("clock", scale=12, shift=hours, low=1, high=12)
        for other in nines[1:3]:
            rules[f"{n}-{other} M 9999"] = _rule("set", "day", y=2, m=_BY_NAME, d=0, dto=1)
        for ordinal in ("st", "nd", "rd", "th"):
            for of in ("", " of"):
                rules[f"{n}{ordinal}{of} M 9999"] = rules[f"{n} M 9999"]
                rules[f"{n}{ordinal}{of} M"] = rules[f"{n} M"]
            rules[f"M {n}{ordinal}, 9999"], rules[f"M {n}{ordinal}"] = rules[f"{n} M 9999"], rules[f"{n} M"]
            rules[f"{n}{ordinal} century"] = _rule("set", "century", y=0, scale=100, shift=-99, years=100, low=1)
            rules[f"{n}{ordinal} century BC"] = _rule("set", "century", y=0, scale=-100, shift=1, years=100, low=1)
        for year in nines[1:]:
            for era, reading in eras.items():
                rules[f"{n} M {year} {era}"] = rules[f"M {n}, {year} {era}"] = _rule("set", "day", y=1, m=_BY_NAME, d=0, **reading)
    for n in nines[2:]:
        rules[f"{n}s"] = _rule("set", "decade", y=0, years=10, step=10)
    for n in nines[1:]:
        rules[f"AD {n}"] = _rule("set", "year", y=0, **eras["AD"])
        for era, reading in eras.items():
            rules[f"{n} {era}"] = _rule("set", "year", y=0, **reading)
            rules[f"M {n} {era}"] = _rule("set", "month", y=0, m=_BY_NAME, **reading)
    for unit, (counted, times) in units.items():
        for word, sign in (("later", 1), ("earlier", -1)):
            for n in nines[1:]:
                rules[f"{n} {unit} {word}"] = rules[f"{n} {unit}s {word}"] = _rule("shift", counted, sign * times, high=_SHIFTS)
        for word, sign in (("following", 1), ("next", 1), ("previous", -1)):
            rules[f"the {word} {unit}"] = rules[f"The {word} {unit}"] = _rule("shift", counted, sign * times)
    return rules


def with_mention_op(df: DataFrame, text: str = "date_text", out: str = "_op") -> DataFrame:
    """Add the operation each mention stands for; absolute forms are fully resolved.

    One lookup by shape gives the reading rule, so a handful of pattern matches and one
    date computation serve all forms.
    """
    t = F.col(text)
    # One literal, folded to a constant when the query is planned.
    table = F.from_json(F.lit(json.dumps(_rules())), _RULES)
    month_name = F.regexp_extract(t, rf"\b{_MONTH}\b", 1)
    n, rule = F.col("_n"), F.col("_rule")
    first = F.coalesce(F.get(n, F.lit(0)), F.lit(1))
    y, m, d = F.col("_ymd.y"), F.col("_ymd.m"), F.col("_ymd.d")
    op, begin = F.col("_name"), F.col("_begin")
    whole = ~F.exists(n, lambda x: x.isNull()) & (F.coalesce(F.get(n, rule["y"]), rule["least"]) >= rule["least"])
    read = whole & first.between(rule["low"], rule["high"]) & (first % rule["step"] == 0)
    last_day, last_month = F.coalesce(F.col("_to.d"), d), F.coalesce(F.col("_to.m"), m)
    exists = y.isNotNull() & m.between(1, 12) & (d >= 1) & (last_day >= d) & (last_day <= F.col("_days"))
    exists = exists & (last_month >= m) & (F.coalesce(F.col("_last"), y) >= y)
    year = F.get(n, rule["y"])
    # A second year of two digits is the next that ends with them.
    upto = F.get(n, rule["upto"])
    short = year - year % 100 + upto

    def number_of(name):
        return (F.array_position(F.array(*[F.lit(x) for x in _NAMES]), name) - 1) % 12 + 1

    second_name = F.get(F.regexp_extract_all(t, F.lit(rf"\b{_MONTH}\b"), F.lit(1)), rule["mto"])
    end = (
        F.when(rule["grain"] == "day", begin + (last_day - d + 1) * DAY)
        .when(rule["mto"].isNotNull(), epoch(y + F.call_function("div", last_month, F.lit(12)), last_month % 12 + 1, F.lit(1)))
        .when(rule["grain"] == "month", begin + F.col("_days") * DAY)
        .otherwise(F.col("_next"))
    )
    steps = {
        "_n": F.transform(F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)), lambda digits: digits.try_cast("bigint")),
        "_rule": F.try_element_at(
            table, F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\d", "9"), "9{5,}", "9+"), rf"\b{_MONTH}\b", "M")
        ),
        "_ymd": F.struct(
            F.when(year.between(0, _YEARS), year * rule["scale"] + rule["shift"]).alias("y"),
            F.when(rule["m"].isNull(), F.lit(1))
            .when(rule["m"] == _BY_NAME, number_of(month_name))
            .otherwise(F.get(n, rule["m"]))
            .alias("m"),
            F.when(rule["d"].isNull(), F.lit(1)).otherwise(F.get(n, rule["d"])).alias("d"),
        ),
        "_days": days_in_month(y, m),
        "_to": F.struct(F.get(n, rule["dto"]).alias("d"), F.when(rule["mto"].isNotNull(), number_of(second_name)).alias("m")),
        "_last": F.when(upto < 100, F.when(short < year, short + 100).otherwise(short)).otherwise(upto),
        "_name": F.when(F.coalesce(~read, F.lit(True)), "fail")
        .when(rule["op"].isin("set", "fix") & ~exists, "fail")
        .when((rule["op"] == "clock") & (F.get(n, F.lit(1)) > 59), "fail")
        .otherwise(rule["op"]),
        "_begin": epoch(y, m, d),
        "_next": epoch(F.coalesce(F.col("_last"), y) + rule["years"], F.lit(1), F.lit(1)),
        "_r": F.struct(
            op.alias("op"),
            F.when(op == "set", begin)
            .when(op == "fix", m)
            .when(op == "shift", first * rule["sign"])
            .when(
                op == "clock",
                F.when(rule["scale"] == 12, first % 12 + rule["shift"]).otherwise(first) * 3600 + F.coalesce(F.get(n, F.lit(1)), F.lit(0)) * 60,
            )
            .alias("a"),
            F.when(op == "set", end - 1).when(op == "fix", d).alias("b"),
            F.when(op.isin("set", "shift"), rule["grain"]).alias("grain"),
        ),
    }
    for name, value in steps.items():
        df = df.withColumn(name, value)
    # The generator keeps later filters from being pushed into the steps, where each filter
    # would carry a copy of all of them for every field it reads.
    return df.select("*", F.explode(F.array("_r")).alias(out)).drop(*steps)
