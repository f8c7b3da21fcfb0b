"""Text columns: Unicode normalisation, whitespace, blank tests.

Everything here is a built-in Spark expression, with one exception: Spark has
no NFKC function, so strings that may change under NFKC go through an Arrow
batch function. Native checks keep all other strings inside the JVM, also those
where only full-width forms, wide spaces or ellipses have to be folded, which
is what ordinary Chinese text needs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import WHITESPACE, ZERO_WIDTH

# Code point ranges, the frequent ones first, whose characters NFKC never changes and that
# never combine with a neighbour. A string of only these and ASCII is already in NFKC form.
_NFKC_STABLE = (
    (0x00BF, 0x0131),
    (0x4E00, 0x9FFF),
    (0x3001, 0x3029),
    (0x3041, 0x3096),
    (0x30A1, 0x30FE),
    (0xAC00, 0xD7A3),
    (0x0400, 0x0481),
    (0x048A, 0x052F),
    (0x2012, 0x2016),
    (0x2018, 0x2023),
    (0x200B, 0x200F),
    (0xFEFF, 0xFEFF),
    (0xFE0F, 0xFE0F),
    (0x0391, 0x03A1),
    (0x03A3, 0x03A9),
    (0x03B1, 0x03C9),
    (0x05D0, 0x05EA),
    (0x0621, 0x063A),
    (0x0641, 0x064A),
    (0x2500, 0x27BF),
    (0x0080, 0x009F),
    (0x00A1, 0x00A7),
    (0x00A9, 0x00A9),
    (0x00AB, 0x00AE),
    (0x00B0, 0x00B1),
    (0x00B6, 0x00B7),
    (0x00BB, 0x00BB),
    (0x0134, 0x013E),
    (0x0141, 0x0148),
    (0x014A, 0x017E),
    (0x0180, 0x01C3),
    (0x01CD, 0x01F0),
    (0x01F4, 0x02AF),
    (0x1F300, 0x1F64F),
    (0x1F680, 0x1F6FF),
    (0x1F900, 0x1F9FF),
)



# Single characters that NFKC turns into one ASCII character, wherever they stand: full-width
# forms and the spaces beyond ASCII; and the ellipsis, which it turns into three dots.
_FOLD_FROM = "".join(map(chr, range(0xFF01, 0xFF5F))) + "".join(
    c for c in WHITESPACE if c > "\x7f" and unicodedata.normalize("NFKC", c) == " "
)
_FOLD_TO = "".join(unicodedata.normalize("NFKC", c) for c in _FOLD_FROM)
_ELLIPSIS = "\u2026"


def _singles(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


def _ranges(pairs: tuple[tuple[int, int], ...]) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in pairs)


_FOLDED = ((0xFF01, 0xFF5E), *((ord(c), ord(c)) for c in _FOLD_FROM[94:] + _ELLIPSIS))
_FREQUENT = ((0x00, 0x7F), *_FOLDED[:1], (0x3000, 0x3029), *_NFKC_STABLE[:2])
_FOLDABLE = f"[[\\x{{A0}}-\\x{{FF5E}}]&&[{_ranges(_FOLDED)}]]"
# The whole text, run by run, in one pass from its start; much faster in Java than a search
# for the first other character. Runs of frequent characters meet the shorter class only.
_UNCHANGING = (
    f"\\A(?:[{_ranges(_FREQUENT)}]++|[\\x{{0}}-\\x{{7F}}{_ranges(_NFKC_STABLE + _FOLDED)}]++)*+\\z"
)
# Whitespace beyond Latin-1 lies between U+1680 and U+3000; Java tests a class part by part.
_LATIN_1 = "".join(c for c in WHITESPACE if ord(c) < 256)
_BEYOND = "".join(c for c in WHITESPACE if ord(c) >= 256)
_WS = f"[{_singles(_LATIN_1)}[\\x{{1680}}-\\x{{3000}}&&[{_singles(_BEYOND)}]]]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normalized(texts: pa.Array) -> pa.Array:
    # Not Arrow's own utf8_normalize, which decomposes but does not compose again.
    nfkc_form = [t if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()]
    return pa.array(nfkc_form, pa.string())


@F.arrow_udf(T.StringType())
def _nfkc_batch(texts: pa.Array) -> pa.Array:
    return _normalized(texts)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkc_list_batch(lists: pa.Array) -> pa.Array:
    # flatten() drops null lists and honours slices, so offsets are rebuilt from lengths.
    values = _normalized(lists.flatten())
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0))
    offsets = pa.concat_arrays([pa.array([0], ends.type), ends])
    kind = pa.LargeListArray if pa.types.is_large_list(lists.type) else pa.ListArray
    return kind.from_arrays(offsets, values, mask=pc.is_null(lists))


def _needs_tables(col: Column) -> Column:
    """Conservative test: false only where ``_fold`` does all that NFKC would do.

    A mark that could combine with a folded character is itself reason enough.
    Pure ASCII, as many bytes as characters, is not even searched.
    """
    return _beyond_ascii(col) & ~F.rlike(col, F.lit(_UNCHANGING))


def _beyond_ascii(col: Column) -> Column:
    return F.octet_length(col) > F.length(col)


def _fold(col: Column) -> Column:
    folded = F.replace(F.translate(col, _FOLD_FROM, _FOLD_TO), F.lit(_ELLIPSIS), F.lit("..."))
    return F.when(_beyond_ascii(col) & F.rlike(col, F.lit(_FOLDABLE)), folded).otherwise(col)


def nfkc(col: Column) -> Column:
    """Unicode NFKC; null stays null."""
    return F.coalesce(_nfkc_batch(F.when(_needs_tables(col), col)), _fold(col))


def nfkc_array(col: Column) -> Column:
    """Unicode NFKC of every string in an array; null lists and elements stay null."""
    needed = F.when(F.exists(col, _needs_tables), col)
    return F.coalesce(_nfkc_list_batch(needed), F.transform(col, _fold))


def strip(col: Column) -> Column:
    """Drop Unicode whitespace from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True if nothing would be left after ``normalize_text``; null counts as blank.

    NFKC maps no other character to pure whitespace, so no normalisation is needed.
    """
    return F.coalesce(F.btrim(col, F.lit(WHITESPACE + ZERO_WIDTH)) == "", F.lit(True))


def _replace_in(col: Column, signs: Sequence[str], pattern: str, new: str) -> Column:
    """Regular expression replacement, only for texts that contain one of ``signs``."""

    def change(text: Column) -> Column:
        found = reduce(or_, [F.contains(text, F.lit(s)) for s in signs])
        return F.when(found, F.regexp_replace(text, pattern, new)).otherwise(text)

    return let(col, change)


def tidy(col: Column) -> Column:
    """The steps of ``normalize_text`` after NFKC. Usable inside a lambda.

    The patterns match only where the text has to change, and are not even
    tried on texts without a tab, a double blank or three line breaks in a row.
    """
    for mark in ZERO_WIDTH:
        col = F.replace(col, F.lit(mark))
    spaces = _replace_in(col, ("\t", "  "), r"[ \t]{2,}|\t", " ")
    return strip(_replace_in(spaces, ("\n\n\n",), r"\n{3,}", "\n\n"))


def normalize_text(col: Column) -> Column:
    """NFKC, no zero-width marks, single blanks, at most one empty line, stripped.

    Null becomes the empty string. Carriage returns and blanks beside a line
    break are left alone.
    """
    return F.coalesce(tidy(nfkc(col)), F.lit(""))


def compact_text(col: Column) -> Column:
    """All whitespace runs to one space, stripped; null becomes the empty string.

    A single space is no match, so ordinary text is scanned but not rebuilt.
    """
    single = F.regexp_replace(col, f"{_WS}(?:(?<! )|{_WS}){_WS}*", " ")
    return F.coalesce(F.btrim(single, F.lit(" ")), F.lit(""))


def char_length(col: Column) -> Column:
    """Number of code points."""
    return F.length(col).cast("bigint")
