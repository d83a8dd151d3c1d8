"""Personal data: format-preserving Feistel pseudonyms (operator 8).

Validated values inside texts are replaced by other values of the same format.
Each kind has its own test (Luhn for card numbers, modulo 97 for account
numbers, ranges for addresses and social numbers, the calendar for dates); what
fails it stays.  An account number ends where its country's length says.  A value's free characters go through a keyed Feistel network
(a permutation of its format's values), so equal values have equal pseudonyms
in every document and different values never share one; check digits are
computed anew.

kind    | permuted                                             | kept
email   | letters and digits before the @                      | the rest
secret  | hexadecimal digits (32 to 64 of them)                | case
card    | all digits but the check digit, made anew            | separators
account | characters after the check digits, made anew         | country
ip      | the four bytes as two 16-bit halves                  | dots
social  | the digits                                           | hyphens
phone   | digits after the country code                        | country code, layout
date    | the day within 1800-01-01 to 2199-12-31 (400 years)  | layout

Only DataFrame functions are used.  A text is split at its matches and joined
again, so there is no shuffle; the key is a parameter or a session setting.

Defined results: a null text stays null, an empty one empty, without values; the
other columns, null or not, are left as they are, but for one named like
``found_col``, which is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.llm.common import fresh

#: The session setting that holds the key where a call gives none.
KEY_SETTING = "spark.quorum.pii.key"
ROUNDS = 8
#: Steps along a permutation's cycle until a number is sound; nine of ten numbers are.
WALK = 64

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"
#: Characters of an account number by country, so that a word or year after it is not read as its last group.
ACCOUNT_CHARS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
_OF_LENGTH = "|".join(
    f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, countries in ACCOUNT_CHARS.items())
ACCOUNT = rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{_OF_LENGTH})(?![0-9A-Za-z])|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![0-9A-Za-z]))"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
CARD = r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])"
KINDS = (("email", EMAIL), ("secret", SECRET), ("account", ACCOUNT), ("date", DATE), ("ip", IP), ("social", SOCIAL), ("card", CARD), ("phone", PHONE))
ANY = "|".join(f"(?:{p})" for _, p in KINDS)

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = ("0123456789abcdef", "0123456789ABCDEF")
#: Days of 400 years of the calendar, as the product of the halves that are permuted.
DAY_HALVES = (27, 5411)
FIRST_DAY = "1800-01-01"
#: Tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy")


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _number(*parts: Column) -> Column:
    """48 keyed pseudo-random bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12), 16, 10).cast("long")


def _shifted(chars: Column, stream: Column, alphabets: tuple[str, ...]) -> Column:
    """Every character moved inside its own alphabet by the stream's bytes."""
    def move(c, i):
        by = F.conv(F.substring(stream, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        for a in alphabets:
            place = F.position(c, F.lit(a)) - 1
            out = F.when(place >= 0, F.substring(F.lit(a), F.pmod(place + by, F.lit(len(a))) + 1, F.lit(1))).otherwise(out)
        return out
    return F.transform(chars, move)


def feistel(chars: Column, key: str, kind: str, alphabets: tuple[str, ...]) -> Column:
    """A keyed permutation of strings that keeps every character's alphabet (array of characters in and out)."""
    half = F.floor(F.size(chars) / 2).cast("int")
    start = F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, F.size(chars)).alias("b"))

    def turn(acc, i):
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.size(chars).cast("string"), F.array_join(acc["b"], "")), 512)
        return F.struct(acc["b"].alias("a"), _let(stream, lambda bits: _shifted(acc["a"], bits, alphabets)).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))


def _feistel_number(u: Column, v: Column, m: int, n: int, key: str, kind: str) -> Column:
    """A keyed permutation of pairs below (m, n)."""
    def turn(acc, i):
        u = F.pmod(acc["u"] + _number(F.lit(key), F.lit(kind), i.cast("string"), acc["v"].cast("string")), F.lit(m))
        return _let(u, lambda new: F.struct(new.alias("u"), F.pmod(
            acc["v"] + _number(F.lit(key), F.lit(kind + "'"), i.cast("string"), new.cast("string")), F.lit(n)).alias("v")))

    start = F.struct(u.cast("long").alias("u"), v.cast("long").alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, turn)


def _refilled(layout: Column, chars: Column, slot: str) -> Column:
    """The layout with its slots (characters that match) taken from ``chars`` in turn."""
    def fill(both):
        whole, new = both["whole"], both["new"]
        return F.array_join(F.transform(whole, lambda c, i: F.when(
            c.rlike(slot), F.get(new, F.size(F.filter(F.slice(whole, F.lit(1), i + 1), lambda x: x.rlike(slot))) - 1)).otherwise(c)), "")

    return _let(F.struct(_chars(layout).alias("whole"), chars.alias("new")), fill)


def _luhn_sum(digits: Column, odd_from_right: int) -> Column:
    n = F.size(digits)
    doubled = F.transform(digits, lambda c, i: F.when((n - i) % 2 == odd_from_right, c.cast("int")).otherwise(
        F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _digits(m: Column) -> Column:
    return _chars(F.regexp_replace(m, "[^0-9]", ""))


def _mod97(text: Column) -> Column:
    """Of an account number's characters, letters counting from 10."""
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _card(m: Column, key: str) -> Column:
    def made(digits):
        body = feistel(F.slice(digits, F.lit(1), F.size(digits) - 1), key, "card", (DIGITS,))
        whole = _let(body, lambda x: F.concat(x, F.array(F.pmod(-_luhn_sum(x, 0), F.lit(10)).cast("string"))))
        return F.when(F.size(digits).between(13, 19) & (_luhn_sum(digits, 1) % 10 == 0), _refilled(m, whole, "[0-9]"))

    return _let(_digits(m), made)


def _account(m: Column, key: str) -> Column:
    def flat_of(x):
        return F.replace(x, F.lit(" "), F.lit(""))

    def valid(flat):
        return F.length(flat).between(15, 34) & (_mod97(F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 4))) == 1)

    def made(number):
        flat = flat_of(number)
        country, rest = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.length(flat))
        body = feistel(_chars(rest), key, "account", (DIGITS, UPPER))
        whole = _let(body, lambda x: F.concat(_chars(country), _chars(F.lpad(
            (98 - _mod97(F.concat(F.array_join(x, ""), country, F.lit("00")))).cast("string"), 2, "0")), x))
        return F.when(number.isNotNull(), F.concat(_refilled(number, whole, "[A-Z0-9]"), F.substring(m, F.length(number) + 1, F.length(m))))

    # Where the country does not tell the length: the longest run of groups that is valid.
    listed = F.substring(m, 1, 2).rlike(f"^(?:{'|'.join(ACCOUNT_CHARS.values())})$")
    ends = _let(F.split(m, " "), lambda words: F.transform(
        F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")))
    numbers = F.when(listed, F.array(m)).otherwise(ends)
    return _let(F.get(F.filter(numbers, lambda x: valid(flat_of(x))), F.lit(0)), made)


def _ip(m: Column, key: str) -> Column:
    def made(part):
        new = _feistel_number(part[0] * 256 + part[1], part[2] * 256 + part[3], 65536, 65536, key, "ip")
        text = _let(new, lambda p: F.concat_ws(".", *(x.cast("string") for x in (F.floor(p["u"] / 256), p["u"] % 256, F.floor(p["v"] / 256), p["v"] % 256))))
        return F.when(F.forall(part, lambda x: x <= 255), text)

    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), made)


def _date(m: Column, key: str) -> Column:
    size = DAY_HALVES[0] * DAY_HALVES[1]
    first = F.lit(FIRST_DAY).cast("date")

    def made(read):
        """read: the format that the date has, and the day."""
        n = F.date_diff(read["day"], first)
        new = _let(_feistel_number(F.floor(n / DAY_HALVES[1]), n % DAY_HALVES[1], *DAY_HALVES, key, "date"),
                   lambda p: F.date_add(first, (p["u"] * DAY_HALVES[1] + p["v"]).cast("int")))
        shown = _let(new, lambda d: F.coalesce(*(F.when(read["f"] == f, F.date_format(d, f)) for f in DATE_FORMATS)))
        return F.when((n >= 0) & (n < size), shown)

    def day(f):
        return F.try_to_timestamp(m, F.lit(f)).cast("date")

    reads = F.array(*(F.struct(F.lit(f).alias("f"), day(f).alias("day")) for f in DATE_FORMATS))
    return _let(F.get(F.filter(reads, lambda r: r["day"].isNotNull()), F.lit(0)), lambda r: F.when(r.isNotNull(), made(r)))


def _sound_social(digits: Column) -> Column:
    number = F.array_join(digits, "")
    area = F.substring(number, 1, 3)
    return ~area.isin("000", "666") & (area < "900") & (F.substring(number, 4, 2) != "00") & (F.substring(number, 6, 4) != "0000")


def _social(m: Column, key: str) -> Column:
    """Permuted until the number passes the test again, which keeps it a permutation of the sound numbers."""
    def step(digits, i):
        return F.when((i == 1) | ~_sound_social(digits), feistel(digits, key, "social", (DIGITS,))).otherwise(digits)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), _digits(m), step)
    return F.when(_sound_social(_digits(m)), _refilled(m, walked, "[0-9]"))


def _phone(m: Column, key: str) -> Column:
    def made(code):
        rest = F.substring(m, F.length(code) + 1, F.length(m))
        return F.concat(code, _refilled(rest, feistel(_digits(rest), key, "phone", (DIGITS,)), "[0-9]"))

    return _let(F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0), made)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    free = F.filter(_chars(local), lambda c: c.rlike("[A-Za-z0-9]"))
    new = _refilled(local, feistel(free, key, "email", (DIGITS, LOWER, UPPER)), "[A-Za-z0-9]")
    return F.concat(new, F.substring(m, F.length(local) + 1, F.length(m)))


def _secret(m: Column, key: str) -> Column:
    return F.array_join(F.when(m.rlike("[A-F]"), feistel(_chars(m), key, "secret", HEX[1:])).otherwise(feistel(_chars(m), key, "secret", HEX[:1])), "")


MAKERS = {"email": _email, "secret": _secret, "account": _account, "date": _date, "ip": _ip, "social": _social, "card": _card, "phone": _phone}


def _named(kind: str, made: Column) -> Column:
    return _let(made, lambda new: F.when(new.isNotNull(), F.struct(F.lit(kind).alias("kind"), new.alias("new"))))


def session_key(spark: SparkSession) -> str:
    """The key of ``KEY_SETTING``; where it is unset a random one, kept for the session.

    Pseudonyms can only be linked over several runs, or undone, with a key that the caller set.
    """
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def pseudonym(m: Column, key: str) -> Column:
    """(kind, new): the first kind whose format the match has and whose test it passes; null if none."""
    return F.coalesce(*(
        _named(kind, F.when(m.rlike(f"^(?:{p})$"), MAKERS[kind](m, key))) for kind, p in KINDS))


def pseudonymised(docs: DataFrame, text_col: str = "text", key: str | None = None, found_col: str = "n_replaced") -> DataFrame:
    """``docs`` with pseudonyms in the text and their number in ``found_col``; without ``key``: :func:`session_key`."""
    key = key or session_key(docs.sparkSession)
    text = F.col(text_col)
    made, parts = fresh(docs, "pseudonyms"), fresh(docs, "parts")
    # Every kind has a digit or an @, so other texts are not searched further.
    matches = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    some = F.size(F.coalesce(F.col(made), F.array())) > 0
    found = (docs.withColumn(made, F.transform(matches, lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("p"))))
             .withColumn(parts, F.when(some, F.split(text, ANY, -1))))
    between = F.zip_with(F.slice(parts, F.lit(1), F.size(made)), F.col(made), lambda a, b: F.concat(a, F.coalesce(b["p"]["new"], b["old"])))
    new_text = F.when(some, F.concat(F.array_join(between, ""), F.element_at(parts, -1))).otherwise(text)
    count = F.when(some, F.size(F.filter(made, lambda x: x["p"].isNotNull()))).otherwise(F.lit(0)).cast("int")
    stay = [c for c in docs.columns if c.lower() != found_col.lower()]
    return found.select(*(new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in stay), count.alias(found_col))
