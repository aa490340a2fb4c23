"""Titles without accents and capitals, in all scripts.

Folding follows the Unicode decompositions: a letter loses its marks, becomes lower case and takes its
compatibility form, which may be several letters. What no decomposition says (strokes, ligatures, final
and insular letters) stands in a short list. Results are equal where a collation of primary strength
finds them equal; the tests compare the two letter by letter.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters whose likeness to others is no decomposition.
ALIKE = {
    "ø": "o", "đ": "d", "ð": "d", "ꝺ": "d", "ł": "l", "ħ": "h", "ꝼ": "f", "ꞣ": "k", "ꞥ": "n", "ꞝ": "o", "ꞅ": "s", "ꞩ": "s", "ꟙ": "s", "ꞇ": "t",
    "ꞟ": "u", "ꞛ": "a", "ꟁ": "a", "ᵹ": "g", "ꞡ": "g", "ꝛ": "r", "ꞃ": "r", "ꞧ": "r", "ꟃ": "w", "æ": "ae", "œ": "oe", "ʣ": "dz", "ꜻ": "ꜹ",
    "ґ": "г", "ꙩ": "о", "ꙫ": "о", "ꙭ": "о", "ꙮ": "о", "ꚙ": "о", "ꚛ": "о", "ך": "כ", "ם": "מ", "ן": "נ", "ף": "פ", "ץ": "צ",
}
# Fixed value: letters whose decomposition is another letter.
APART = "ٵٶٷٸﯝ𛄡"
# Marks that make another letter, on any letter or on one.
LETTER_MARKS = "\u0653\u0654\u0655"
MARKED_LETTERS = {"и\u0306": "й", **{unicodedata.normalize("NFD", c): c for c in "آأؤإئ"}}
# Hangul syllables would become sequences of their parts; they have no case and no accents.
_HANGUL = range(0xAC00, 0xD7A4)


@cache
def _is_mark(c: str) -> bool:
    """Marks that only accent: those with a place of their own, but not the signs that kill a vowel, nor
    letters written above others."""
    accent = unicodedata.category(c) in ("Mn", "Me") and unicodedata.combining(c) not in (0, 9) and c not in LETTER_MARKS
    return accent and "LETTER" not in unicodedata.name(c, "")


def _bare(text: str) -> str:
    """Decomposed without accents, letters that a mark makes put together."""
    text = unicodedata.normalize("NFKD", text)
    for apart, together in MARKED_LETTERS.items():
        text = text.replace(apart, together)
    return "".join(c for c in text if not _is_mark(c))


def _one_kana(c: str) -> str:
    """The hiragana of a sound, for its katakana and small forms."""
    name = unicodedata.name(c, "")
    if not name.startswith(("HIRAGANA LETTER", "KATAKANA LETTER")):
        return c
    try:
        return unicodedata.lookup(name.replace("KATAKANA", "HIRAGANA").replace(" SMALL ", " "))
    except KeyError:
        return c


def fold_letter(c: str) -> str:
    """What a letter becomes; may be several letters."""
    if ord(c) in _HANGUL or c in APART:
        return c
    folded = _bare(_bare(c).casefold())
    folded = "".join(_one_kana(x) for x in "".join(ALIKE.get(x, x) for x in folded))
    # Forms of a mark that stands alone stay as they are.
    return c if not folded or " " in folded else folded


@cache
def _tables() -> tuple[str, str, dict[str, str], str]:
    """Letters that become one letter, what they become, those that become several, and the marks."""
    single, several, marks = {}, {}, []
    for code in range(0x80, 0x30000):
        c = chr(code)
        category = unicodedata.category(c)
        if category[0] == "L":
            folded = fold_letter(c)
            if len(folded) > 1:
                several[c] = folded
            elif folded != c:
                single[c] = folded
        elif category[0] == "M" and _is_mark(c):
            marks.append(c)
    return "".join(single), "".join(single.values()), several, "".join(marks)


def fold_title(title: Column) -> Column:
    """Lower case without accents: equal for titles that an insensitive search should not tell apart.

    Plain ASCII, by far the most frequent, is only put in lower case. Of all others a single pass maps the letters and
    drops the marks. Letters that become several are replaced letter by letter, in titles that hold one: what they become
    holds none, and a title of any length holds few different ones, so that few are looked up."""
    single, becomes, several, marks = _tables()
    joined = F.lower(title)
    for apart, together in MARKED_LETTERS.items():
        joined = F.replace(joined, F.lit(apart), F.lit(together))
    # What has no counterpart is dropped.
    bare = F.translate(joined, single + marks, becomes)
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")

    def spelled(text):
        letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: (F.octet_length(c) > 1) & F.map_contains_key(table, c))
        return F.aggregate(letters, text, lambda done, c: F.replace(done, c, F.element_at(table, c)))

    wide = F.translate(title, "".join(several), "") != title
    # In an array, so that the letters are mapped once.
    spelled = F.element_at(F.transform(F.array(bare), spelled), 1)
    return F.when(F.octet_length(title) == F.length(title), F.lower(title)).when(wide, spelled).otherwise(bare)
