"""One form for texts that look the same, and the words and digits of a text.

Look-alike folding leaves letter case, accents, punctuation and the number of spaces alone. It folds full-width
forms, kinds of space, invisible characters and letters of other alphabets with a Latin shape, and composes accents.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other alphabets that have the shape of a Latin letter, each below the letter it looks like.
GREEK_SHAPES = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοϲϳ"
GREEK_LATIN_ = "ABEZHIKMNOPTYXvocj"
CYRILLIC_SHAPES = "АВЕЅІЈКМНОРСТУХҮԌԚԜаеорсухѕіјһԁԛԝүӏ"
CYRILLIC_LATIN_ = "ABESIJKMHOPCTYXYGQWaeopcyxsijhdqwyl"
ARMENIAN_SHAPES = "ՕՍօոսհզ"
ARMENIAN_LATIN_ = "OUonuhq"
#: Invisible without being format characters: grapheme joiner, Hangul fillers, Khmer inherent vowels.
INVISIBLE_LETTERS = "͏ᅟᅠ឴឵ㅤﾠ"

#: Blocks that hold spaces, format characters, variation selectors and full-width forms (ends exclusive).
FORMAT_BLOCKS = [(0x20, 0x3400), (0xFE00, 0x10000), (0x110BD, 0x110CE), (0x13430, 0x13460), (0x1BCA0, 0x1BCA4), (0x1D173, 0x1D17B), (0xE0000, 0xE01F0)]


def _look_alikes() -> dict[int, str]:
    table = {}
    for shapes, latin in ((GREEK_SHAPES, GREEK_LATIN_), (CYRILLIC_SHAPES, CYRILLIC_LATIN_), (ARMENIAN_SHAPES, ARMENIAN_LATIN_)):
        table.update(zip(map(ord, shapes), latin, strict=True))
    # accented letters of those alphabets follow their base letter where the Latin one exists in one code point
    for code in range(0x370, 0x530):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and ord(base) in table:
            composed = unicodedata.normalize("NFC", table[ord(base)] + "".join(marks))
            if len(composed) == 1:
                table[code] = composed
    return table


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for code in chain.from_iterable(map(range, *zip(*FORMAT_BLOCKS, strict=True))):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Zs":
            table[code] = " "
        elif kind == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or char in INVISIBLE_LETTERS:
            table[code] = None
        elif 0xFF01 <= code <= 0xFF5E or 0xFFE0 <= code <= 0xFFE6:
            table[code] = chr(int(unicodedata.decomposition(char).split()[1], 16))
    return table | _look_alikes()


FOLD = _fold_table()
#: Runs outside ASCII, Latin letters and combining marks, where alone there may be something to fold. A class of every
#: character in the table would be searched range by range.
_SUSPECT = re.compile("[^\x00-\x7f\xa1-\xac\xae-\u024f\u0300-\u034e\u0350-\u036f]+")
WORD = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")


def fold(text: str) -> str:
    """``text`` with every look-alike difference taken out; composed (NFC)."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", _SUSPECT.sub(lambda m: m[0].translate(FOLD), text))


def words(text: str) -> list[str]:
    """Case-folded runs of letters and digits of the folded text."""
    return WORD.findall(fold(text).casefold())


def digits_of(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def words_with_offsets(text: str) -> list[tuple[str, int, int]]:
    """``words`` with the half-open code-point range of each in the original text.

    Folding drops or joins characters, so each folded character keeps the range of the original ones it came from.
    """
    kept: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    for i, char in enumerate(text):
        to = FOLD.get(ord(char), char)
        if to is None:
            continue
        if kept and unicodedata.combining(to) and len(joined := unicodedata.normalize("NFC", kept[-1] + to)) == len(kept[-1]):
            kept[-1], ends[-1] = joined, i + 1
            continue
        kept.append(to)
        starts.append(i)
        ends.append(i + 1)
    lowered: list[str] = []
    at: list[int] = []
    for i, char in enumerate(kept):
        for c in unicodedata.normalize("NFC", char).casefold():
            lowered.append(c)
            at.append(i)
    return [(m.group(), starts[at[m.start()]], ends[at[m.end() - 1]]) for m in WORD.finditer("".join(lowered))]


def mapped(column: Column) -> Column:
    """The same folding inside the JVM, but for composing accents, which a Unicode collation takes care of."""
    kept = {c: t for c, t in FOLD.items() if t is not None and c > 127}
    gone = "".join(chr(c) for c, t in FOLD.items() if t is None and not 0xE0000 <= c)
    plane14 = "[\\x{E0001}-\\x{E007F}\\x{E0100}-\\x{E01EF}]"
    folded = F.translate(column, "".join(map(chr, kept)) + gone, "".join(kept.values()))
    return F.when(column.rlike("^\\p{ASCII}*$"), column).otherwise(F.regexp_replace(folded, plane14, ""))
