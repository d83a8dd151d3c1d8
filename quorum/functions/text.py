"""Text and numeric column builders (all JVM-side, codegen friendly).

Every function takes and returns a ``Column``; nothing here runs Python per
row.  Null handling follows the survey process: normalisers keep null unless
the name says otherwise (``*_or_empty``).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = " "

# The whitespace set of Python's str.isspace() (what str.strip()/split() use),
# generated by rule: nbsp, the Unicode spaces and the ASCII controls 9-13, 28-31.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Words of visible ASCII or Latin letters and signs with one space between them: texts that :func:`normalize` leaves as they are.
_NORMAL = "\\A(?:[!-~\u00a1-\u024f]++(?: [!-~\u00a1-\u024f]++)*+)?\\z"


def strip(c) -> Column:
    """SC1: trim Unicode whitespace (nbsp included) on both ends; null kept."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def collapse_spaces(c) -> Column:
    """SC4: every whitespace run becomes one space; the pattern only sees texts with two in a row."""
    plain = F.translate(_c(c), WHITESPACE, " " * len(WHITESPACE))
    return F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " +", " ")).otherwise(plain)


def nbsp_to_space(c) -> Column:
    """SC3."""
    return F.translate(_c(c), NBSP, " ")


def normalize(c) -> Column:
    """SC5: nbsp -> space, collapse runs, trim; null kept.

    One search tells most texts that stay as they are; ``translate`` looks up every character, which
    takes far longer.
    """
    c = _c(c).cast("string")
    return F.when(c.rlike(_NORMAL), c).otherwise(F.trim(collapse_spaces(nbsp_to_space(c))))


def normalize_or_empty(c) -> Column:
    """SC6: SC5 with null -> ''."""
    return F.coalesce(normalize(c), F.lit(""))


def _hangul(cp: int) -> bool:
    return 0xAC00 <= cp < 0xD7A4


def _folded(ch: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Accent folding over the whole Basic Multilingual Plane, generated by rule from ``unicodedata``.

    Two strings for ``translate`` (characters that fold to one character, then those that fold to
    none, such as combining marks) and a map of those that fold to several (ligatures, fractions).
    Left as they are: Hangul syllables, whose parts would be several letters each, and what lies
    beyond the plane.
    """
    one, none, several = {}, [], {}
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if 0xD800 <= cp < 0xE000 or _hangul(cp):
            continue
        new = _folded(ch)
        if new == ch:
            continue
        if not new:
            none.append(ch)
        elif len(new) == 1:
            one[ch] = new
        else:
            several[ch] = new
    return "".join(one) + "".join(none), "".join(one.values()), several


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def remove_accents(c) -> Column:
    """SC7: NFKD folding without combining marks (null kept).

    ASCII texts are left as they are, others go through one ``translate``; only what then still holds
    a character that folds to several (found by a second ``translate`` that takes them out, no
    pattern) goes through a map, character by character.
    """
    c = _c(c)
    matching, replace, several = _accent_table()
    text = F.translate(c, matching, replace)
    # One literal, folded to a map once; no folded form holds the separators.
    table = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02"))
    wide = ~_is_ascii(text) & (F.translate(text, "".join(several), "") != text)
    each = F.array_join(F.transform(F.split(text, ""), lambda x: F.coalesce(F.element_at(table, x), x)), "")
    return F.when(_is_ascii(c), c).when(wide, each).otherwise(text)


def fold_key(c) -> Column:
    """SC8: strip, upper, remove accents, collapse whitespace; null -> ''.

    Stripped once, at the end, when every whitespace is a space.
    """
    return F.coalesce(F.trim(collapse_spaces(remove_accents(F.upper(_c(c))))), F.lit(""))


def meta_key(c) -> Column:
    """JN4 key: SC6 then accent removal then upper (null -> '')."""
    return F.upper(remove_accents(normalize_or_empty(c)))


def header_key(name: str) -> str:
    """SC9 on a column name (driver side, metadata only)."""
    text = " ".join(_fold_py(name).split())
    return text.replace(" ", "").replace("_", "")


def _fold_py(value) -> str:
    if value is None:
        return ""
    text = str(value).strip().upper()
    text = unicodedata.normalize("NFKD", text)
    return "".join(x for x in text if not unicodedata.combining(x))


def fold_key_py(value) -> str:
    """Driver-side twin of :func:`fold_key` for config values (rule lists)."""
    return " ".join(_fold_py(value).split())


def drop_decimal_zero(c) -> Column:
    """SC10 (a): remove a trailing '.0' that follows a digit."""
    return F.regexp_replace(_c(c), r"(?<=\d)\.0$", "")


def drop_decimal_zero_trimmed(c) -> Column:
    """SC10 (b): trim, then remove any trailing '.0'."""
    return F.regexp_replace(strip(c), r"\.0$", "")


_NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


_NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def to_number(c) -> Column:
    """SC11: numeric coercion, anything unparsable -> null.

    The regex guard keeps Spark from accepting forms such as '1d' or 'NaN'.
    Numeric inputs are cast directly (not a number -> null): their type is known to the optimiser, which drops the test.
    """
    c = _c(c)
    s = strip(c.cast("string"))
    text = F.when(s.rlike(_NUMERIC), s.cast("double"))
    return F.when(F.typeof(c).isin(*_NUMBER_TYPES) | F.startswith(F.typeof(c), F.lit("decimal")),
                  F.nullif(c.cast("double"), F.lit(float("nan")))).otherwise(text)


def round2(c) -> Column:
    """SC13: two decimals, ties to even (numpy's round)."""
    return F.rint(_c(c) * 100) / 100


def row_count_valid(cols) -> Column:
    """SC12 count: how many of ``cols`` are not null."""
    return reduce(lambda a, b: a + b,
                  [F.when(_c(x).isNotNull(), 1).otherwise(0) for x in cols]).cast("long")


def row_mean(cols) -> Column:
    """SC12 mean over non-null values, all null -> null."""
    total = reduce(lambda a, b: a + b,
                   [F.coalesce(_c(x).cast("double"), F.lit(0.0)) for x in cols])
    n = row_count_valid(cols)
    return F.when(n > 0, total / n)


def flag(c) -> Column:
    """SC15: sim/s/true/1/yes -> true; anything else, null included -> false."""
    from quorum.config.operator import TRUE_FLAGS
    return F.coalesce(F.lower(strip(_c(c).cast("string"))).isin(*TRUE_FLAGS), F.lit(False))


def key_to_name_default(c) -> Column:
    """JN10 fallback: key with '_' replaced by ' '."""
    return F.replace(_c(c), F.lit("_"), F.lit(" "))


def slug(c) -> Column:
    """SC19: accents folded, other characters outside ASCII dropped, non-alphanumeric runs -> '_', trimmed '_', lower."""
    s = F.regexp_replace(remove_accents(_c(c)), r"[^\x00-\x7F]+", "")
    s = F.regexp_replace(s, r"[^a-zA-Z0-9]+", "_")
    s = F.lower(F.regexp_replace(s, r"^_+|_+$", ""))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("sem_nome"))


def blank_columns(cols) -> Column:
    """SC20: names of the blank columns, joined by ', '."""
    from quorum.functions.predicates import is_blank
    return F.concat_ws(", ", *[F.when(is_blank(x), F.lit(x)) for x in cols])
