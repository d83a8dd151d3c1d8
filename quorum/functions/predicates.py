"""Predicate builders with the survey process's null semantics.

* equality / inequality with null is unknown -> the row is not hit (SQL 3VL);
* regex "contains" maps null to false, so its negation maps null to true;
* "blank" means null or ''.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """FI7: null or ''."""
    return F.coalesce(_c(c), F.lit("")) == ""


def as_list(v):
    """Scalar promoted to list, None kept (rule fields)."""
    if v is None:
        return None
    return list(v) if isinstance(v, (list, tuple)) else [v]


def in_list(c, values) -> Column:
    """FI2: value in list (null -> not hit)."""
    return F.coalesce(_c(c).isin(*values), F.lit(False))


def not_in_list(c, values) -> Column:
    """FI2 negated: null passes, like ``~Series.isin``."""
    return ~F.coalesce(_c(c).isin(*values), F.lit(False))


def equals(c, v) -> Column:
    """FI3: unknown on null -> treated as not hit."""
    return F.coalesce(_c(c) == F.lit(v), F.lit(False))


def differs(c, v) -> Column:
    """FI3 inequality, unknown on null -> not hit."""
    return F.coalesce(_c(c) != F.lit(v), F.lit(False))


#: Characters outside ASCII that a case-insensitive Unicode search takes for an ASCII letter.
_LIKE_ASCII = ("\u0130\u0131\u017f\u212a", "iisk")


def plain_words(pattern: str) -> list[str]:
    """The alternatives of a pattern that is nothing but ASCII words separated by ``|``, else none."""
    words = pattern.split("|") if re.fullmatch("[A-Za-z0-9 _|-]+", pattern) else []
    return [w.lower() for w in words] if all(words) else []


def regex_contains(c, pattern: str) -> Column:
    """FI4: case-insensitive (Unicode) regex search, null -> false.

    Plain words are looked for in the lower-cased text, which finds the same and takes a fraction of
    the search's time.
    """
    words, text = plain_words(pattern), _c(c)
    if words:
        ascii_only = F.octet_length(text) == F.length(text)
        low = F.lower(F.when(ascii_only, text).otherwise(F.translate(text, *_LIKE_ASCII)))
        return F.coalesce(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), F.lit(False))
    return F.coalesce(_c(c).rlike("(?iu)" + pattern), F.lit(False))


def regex_not_contains(c, pattern: str) -> Column:
    """FI5: negation of FI4, null -> true."""
    return ~regex_contains(c, pattern)


def all_of(conds) -> Column:
    """FI12/FI13: conjunction; no condition = every row."""
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


#: FI8: what the positive comparators test; "diferente", "nao_*" are their negations.
POSITIVE = {
    "igual": lambda text, value: text == F.lit(value),
    "contem": lambda text, value: F.upper(text).contains((value or "").upper()),
    "vazio": lambda text, value: text == "",
}
NEGATED = {"diferente": "igual"} | {f"nao_{p}": p for p in ("contem", "vazio")}


def comparator(c, op: str, value: str | None) -> Column:
    """FI8: six comparators over a column normalised with null -> ''."""
    from quorum.functions.text import normalize_or_empty
    test = POSITIVE.get(NEGATED.get(op, op))
    if test is None:
        raise ValueError(f"unsupported comparator: {op}")
    hit = test(normalize_or_empty(c), value)
    return ~hit if op in NEGATED else hit


def between(c, lo, hi) -> Column:
    """FI9 inclusive range, null -> false."""
    return F.coalesce(_c(c).between(lo, hi), F.lit(False))


def at_least(c, lo) -> Column:
    return F.coalesce(_c(c) >= lo, F.lit(False))


def adhoc_filter(df, tipo=None, contratacao=None, local=None, especialidade=None,
                 classificacao=None, tipo_diferente=None, contratacao_diferente=None,
                 local_diferente=None, especialidade_diferente=None,
                 classificacao_diferente=None):
    """FI10: optional positive/negative filters (None = not applied).

    TIPO numeric equality; CONTRATACAO/CLASSIFICACAO trimmed lower-case
    equality; LOCAL/ESPECIALIDADE trimmed lower-case literal containment.
    """
    from quorum.functions.text import strip, to_number

    def norm(c):
        return F.lower(strip(_c(c)))

    def low(v):
        return str(v).strip().lower()

    conds = []
    t = to_number(_c("TIPO"))
    if tipo is not None:
        conds.append(F.coalesce(t == tipo, F.lit(False)))
    if tipo_diferente is not None:
        conds.append(~F.coalesce(t == tipo_diferente, F.lit(False)))  # NaN != x is true
    for col, v, neg in (("CONTRATACAO", contratacao, False), ("CONTRATACAO", contratacao_diferente, True),
                        ("CLASSIFICACAO", classificacao, False), ("CLASSIFICACAO", classificacao_diferente, True)):
        if v is not None:
            e = (norm(col) != low(v)) if neg else (norm(col) == low(v))
            conds.append(F.coalesce(e, F.lit(False)))
    for col, v, neg in (("LOCAL", local, False), ("LOCAL", local_diferente, True),
                        ("ESPECIALIDADE", especialidade, False), ("ESPECIALIDADE", especialidade_diferente, True)):
        if v is not None:
            e = F.coalesce(norm(col).contains(low(v)), F.lit(False))
            conds.append(~e if neg else e)
    return df.where(all_of(conds)).select("TIPO", "CONTRATACAO", "LOCAL", "ESPECIALIDADE", "CLASSIFICACAO")
