"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Values are found in the text by one pattern, validated, and replaced by a keyed permutation of their own
format: the same value gives the same pseudonym in every document, different values of a kind give
different pseudonyms, and whoever holds the key can turn a pseudonym back.  Everything around the values
stays as it is.

kind      validated by                                   kept                permuted
email     user@domain.tld, user at most 64 characters    domain, marks       letters and digits of the user
ip        four octets of 0 to 255                        dotted form         the 32-bit number
date      the calendar, 1900 to 2099; Y-M-D, Y/M/D,      notation            the day among all days of 1900-2099
          D.M.Y, M/D/Y (D/M/Y where only that is a day)
ssn       area, group and serial in use                  notation            the number among all valid ones
iban      length and check digits (mod 97)               country, notation   letters and digits, check digits renewed
phone     North American plan, with or without +1 and    notation            the number among all valid ones
          separators; ten bare digits stand alone
intl      + and 8 to 15 digits                           country code, (0)   the other digits
card      13 to 19 digits with a Luhn check digit        first digit         the others, check digit renewed
secret    8 or more letters, digits, _ and - named       name, AKIA, marks   letters and digits
          token, key, secret or password; AKIA and 16 more

Both permutations are Feistel networks of eight rounds with HMAC-like round keys from SHA-256: one over
the two halves of a string, shifting every character inside its class (digit, lower, upper case; beyond ASCII
a run of neighbours of one Unicode category, or all characters of it that have none), one over
numbers x * b + y with x below a and y below b, so a range of exactly a * b numbers is permuted without
cycle walking.

Defined cases: null text stays null and has no values; values that fail validation stay as they are and
are not counted; a pseudonym is never searched again.  Rows are independent: repeated rows repeat, an
empty table gives an empty table.  The patterns use possessive or bounded repetition, so very long texts
take linear time.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.registry import free_name

ROUNDS = 8
KINDS = ("email", "ip", "date", "ssn", "iban", "phone", "intl", "card", "secret")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Order decides between kinds that could start at the same place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "date": r"(?<![\d./-])(?:(?:19|20)\d\d(?:-\d\d-|/\d\d/)\d\d|\d\d\.\d\d\.(?:19|20)\d\d|\d\d/\d\d/(?:19|20)\d\d)(?![/-]?\d)",
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\d)"
             r"|(?<![\d+])\+1[ .-]?(?:\([2-9]\d\d\)|[2-9]\d\d)[ .-]?[2-9]\d\d[ .-]?\d{4}(?!\d)"
             r"|(?<![\p{L}\p{N}+_])(?<!\d[.,/-])(?:1[ .-]?)?(?:\([2-9]\d\d\)|[2-9]\d\d)[ .-]?[2-9]\d\d[ .-]?\d{4}(?![\p{L}\p{N}_]|[.,/-]\d)",
    "intl": r"(?<![\d+])\+[2-9]\d{0,2}(?:[ .-]?\(0\))?(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)",
    "secret": r"(?<=[=: \"'])(?<=(?:token|key|secret|password) ?[=:] ?[\"']?)(?=[A-Za-z_-]*+\d)[0-9A-Za-z_-]{8,}+|(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
}
# Fixed value: country calling codes of one and two digits; all others have three.
CALLING_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_HINT = r"[@\d]|AKIA"

_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)  # 73049 days up to 2099-12-31


def _noise(key: str, kind: str, i: Column, value: Column) -> Column:
    """64 hex digits that depend on key, kind, round and value."""
    inner = F.sha2(F.concat(F.lit(f"{key}|inner|{kind}|"), i.cast("string"), F.lit("|"), value), 256)
    return F.sha2(F.concat(F.lit(f"{key}|outer|"), inner), 256)


def _pieces(s: Column) -> Column:
    return F.split(s, "")


def _classes() -> tuple[list[tuple[int, int]], list[str]]:
    """Letters and digits beyond ASCII: (first, size) of the runs of one category, and the strings of those without neighbours."""
    runs, single, first, kind = [], {}, 0, None
    for c in range(128, sys.maxunicode + 2):
        now = unicodedata.category(chr(c)) if c <= sys.maxunicode else None
        if now != kind:
            if kind and kind[0] in "LN":
                if c - first > 1:
                    runs.append((first, c - first))
                else:
                    single[kind] = single.get(kind, "") + chr(first)
            first, kind = c, now
    return runs, list(single.values())


_RUNS, _SINGLES = _classes()


def _shift_wide(c: Column, k: Column) -> Column:
    """A character beyond ASCII, moved by ``k`` inside its class."""
    code = F.ascii(c)
    # one folded literal: first * 65536 + size
    runs = F.split(F.lit(",".join(str(a << 16 | n) for a, n in _RUNS)), ",").cast("array<long>")
    run = F.filter(runs, lambda r: (code >= F.shiftright(r, 16)) & (code < F.shiftright(r, 16) + r.bitwiseAND(F.lit(65535))))

    def moved(r: Column) -> Column:
        to = F.pmod(code - F.shiftright(r, 16) + k, r.bitwiseAND(F.lit(65535))) + F.shiftright(r, 16)
        return F.decode(F.unhex(F.lpad(F.hex(to), 8, "0")), "UTF-32")

    out = c
    for chars in _SINGLES:
        at = F.instr(F.lit(chars), c)
        out = F.when(at > 0, F.substring(F.lit(chars), F.pmod(at - 1 + k, F.lit(len(chars))) + 1, F.lit(1))).otherwise(out)
    return F.coalesce(F.get(F.transform(run, moved), F.lit(0)), out)


def _shift(s: Column, noise: Column, beyond: bool) -> Column:
    def one(c: Column, j: Column) -> Column:
        at = F.pmod(j, F.lit(32)) * 2 + 1
        k = F.conv(F.substring(noise, at, F.lit(2)), 16, 10).cast("int")
        wide = F.conv(F.substring(noise, F.pmod(j, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        a = F.ascii(c)

        def turn(base: int, size: int) -> Column:
            return F.char(F.pmod(a - base + k, F.lit(size)) + base)

        return (F.when(a.between(48, 57), turn(48, 10)).when(a.between(65, 90), turn(65, 26))
                .when(a.between(97, 122), turn(97, 26)).when(a < 128, c).otherwise(_shift_wide(c, wide) if beyond else c))

    return F.array_join(F.transform(_pieces(s), one), "")


def permute_text(s: Column, key: str, kind: str, beyond: bool = False) -> Column:
    """Keyed permutation of the strings with the same pattern of digits, lower and upper case letters; ``beyond``: not of ASCII only."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))

    def round_(acc: Column, i: Column) -> Column:
        left = F.struct(_shift(acc["l"], _noise(key, kind, i, acc["r"]), beyond).alias("l"), acc["r"].alias("r"))
        right = F.struct(acc["l"].alias("l"), _shift(acc["r"], _noise(key, kind, i, acc["l"]), beyond).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda acc: F.concat(acc["l"], acc["r"]))


def permute_number(n: Column, a: int, b: int, key: str, kind: str) -> Column:
    """Keyed permutation of the numbers 0 to a * b - 1."""
    n = n.cast("long")
    start = F.struct(F.floor(n / b).cast("long").alias("x"), F.pmod(n, F.lit(b)).cast("long").alias("y"))

    def draw(i: Column, value: Column) -> Column:
        return F.conv(F.substring(_noise(key, kind, i, value.cast("string")), 1, 15), 16, 10).cast("long")

    def round_(acc: Column, i: Column) -> Column:
        x = F.struct(F.pmod(acc["x"] + draw(i, acc["y"]), F.lit(a)).cast("long").alias("x"), acc["y"].alias("y"))
        y = F.struct(acc["x"].alias("x"), F.pmod(acc["y"] + draw(i, acc["x"]), F.lit(b)).cast("long").alias("y"))
        return F.when(i % 2 == 0, x).otherwise(y)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda acc: acc["x"] * b + acc["y"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _refill(shape: Column, digits: Column, keep: int = 0) -> Column:
    """``shape`` with its digits replaced one by one by ``digits``; the first ``keep`` digits of shape are skipped."""
    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        taken = F.when(acc["n"] < keep, c).otherwise(F.substring(digits, acc["n"] - keep + 1, F.lit(1)))
        return F.struct(F.concat(acc["s"], F.when(is_digit, taken).otherwise(c)).alias("s"),
                        (acc["n"] + F.when(is_digit, 1).otherwise(0)).alias("n"))

    return F.aggregate(_pieces(shape), F.struct(F.lit("").alias("s"), F.lit(0).alias("n")), step, lambda acc: acc["s"])


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum; ``double_last``: the last digit counts double, as in front of a check digit still to come."""
    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct((acc["s"] + F.when(acc["x"], twice).otherwise(d)).alias("s"), (~acc["x"]).alias("x"))

    return F.aggregate(_pieces(F.reverse(digits)), F.struct(F.lit(0).alias("s"), F.lit(double_last).alias("x")), step,
                       lambda acc: acc["s"])


def _mod97(chars: Column) -> Column:
    def step(acc: Column, c: Column) -> Column:
        a = F.ascii(c)
        return F.when(a < 65, F.pmod(acc * 10 + a - 48, F.lit(97))).otherwise(F.pmod(acc * 100 + a - 55, F.lit(97))).cast("int")

    return F.aggregate(_pieces(chars), F.lit(0), step)


def _email(v: Column, key: str) -> Column:
    return F.concat(permute_text(F.substring_index(v, "@", 1), key, "email", True), F.lit("@"), F.substring_index(v, "@", -1))


def _ip(v: Column, key: str) -> Column:
    octets = F.split(v, r"\.")
    n = octets[0].cast("long") * 16777216 + octets[1].cast("long") * 65536 + octets[2].cast("long") * 256 + octets[3].cast("long")

    def dotted(m: Column) -> Column:
        return F.concat_ws(".", *[F.pmod(F.floor(m / (1 << s)), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])

    return F.transform(F.array(permute_number(n, 65536, 65536, key, "ip")), dotted)[0]


def _date(v: Column, key: str) -> Column:
    def moved(fmt: str) -> Column:
        day = F.try_to_timestamp(v, F.lit(fmt)).cast("date")
        n = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
        return F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), permute_number(n, *_DAYS, key, "date").cast("int")), fmt)

    return (F.when(v.rlike(r"^\d{4}-"), moved("yyyy-MM-dd")).when(v.rlike(r"^\d{4}/"), moved("yyyy/MM/dd"))
            .when(v.contains("."), moved("dd.MM.yyyy")).otherwise(F.coalesce(moved("MM/dd/yyyy"), moved("dd/MM/yyyy"))))


def _ssn(v: Column, key: str) -> Column:
    part = F.split(v, "-")
    area = part[0].cast("long") - 1
    area = F.when(area > 664, area - 1).otherwise(area)
    n = (area * 99 + part[1].cast("long") - 1) * 9999 + part[2].cast("long") - 1

    def shown(m: Column) -> Column:
        block = F.floor(m / 9999)
        at = F.floor(block / 99) + 1
        at = F.when(at > 665, at + 1).otherwise(at)
        return F.concat_ws("-", F.lpad(at.cast("string"), 3, "0"),
                           F.lpad((F.pmod(block, F.lit(99)) + 1).cast("string"), 2, "0"),
                           F.lpad((F.pmod(m, F.lit(9999)) + 1).cast("string"), 4, "0"))

    return F.transform(F.array(permute_number(n, 898 * 99, 9999, key, "ssn")), shown)[0]


def _iban(v: Column, key: str) -> Column:
    plain = F.regexp_replace(v, " ", "")
    country, rest = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(rest, F.substring(plain, 1, 4))) == 1

    def shown(body: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        flat = F.concat(country, check, body)
        spaced = F.rtrim(F.regexp_replace(flat, "(.{4})", "$1 "))
        return F.when(v.contains(" "), spaced).otherwise(flat)

    moved = F.transform(F.array(permute_text(rest, key, "iban")), shown)[0]
    return F.when(valid, moved)


def _phone(v: Column, key: str) -> Column:
    ten = F.substring(_digits(v), -10, 10)
    n = (((F.substring(ten, 1, 3).cast("long") - 200) * 800 + F.substring(ten, 4, 3).cast("long") - 200) * 10000
         + F.substring(ten, 7, 4).cast("long"))

    def ten_of(m: Column) -> Column:
        front = F.floor(m / 10000)
        return F.concat((F.floor(front / 800) + 200).cast("string"), (F.pmod(front, F.lit(800)) + 200).cast("string"),
                        F.lpad(F.pmod(m, F.lit(10000)).cast("string"), 4, "0"))

    new = F.transform(F.array(permute_number(n, 80000, 80000, key, "phone")), ten_of)[0]
    return F.when(F.length(_digits(v)) == 11, _refill(v, new, 1)).otherwise(_refill(v, new))


def _intl(v: Column, key: str) -> Column:
    marked = F.replace(v, F.lit("(0)"), F.lit("(o)"))  # the trunk zero stays where it is
    bare = _digits(marked)
    code = F.regexp_extract(bare, CALLING_CODE, 0)
    body = F.substring(bare, F.length(code) + 1, F.length(bare))
    moved = F.replace(_refill(marked, F.concat(code, permute_text(body, key, "intl"))), F.lit("(o)"), F.lit("(0)"))
    return F.when(F.length(_digits(v)).between(8, 15), moved)


def _card(v: Column, key: str) -> Column:
    d = _digits(v)
    valid = _luhn_sum(d, False) % 10 == 0
    body = F.substring(d, F.lit(2), F.length(d) - 2)

    def shown(b: Column) -> Column:
        front = F.concat(F.substring(d, 1, 1), b)
        return F.concat(front, F.pmod(10 - _luhn_sum(front, True) % 10, F.lit(10)).cast("string"))

    return F.when(valid, _refill(v, F.transform(F.array(permute_text(body, key, "card")), shown)[0]))


def _secret(v: Column, key: str) -> Column:
    return F.when(v.rlike("^AKIA[0-9A-Z]{16}$"), F.concat(F.lit("AKIA"), permute_text(F.substring(v, 5, 16), key, "secret"))
                  ).otherwise(permute_text(v, key, "secret"))


_RULES = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "iban": _iban, "phone": _phone, "intl": _intl,
          "card": _card, "secret": _secret}


def _kind(v: Column) -> Column:
    out = F.when(v.contains("@"), "email")
    for kind in KINDS[1:-1]:
        out = out.when(v.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("secret")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised, and the columns n_values and n_<kind> of what was replaced.

    ``key`` is the secret that fixes the permutations; keep it out of code and logs in production.
    """
    body = F.col(f"`{text}`")
    may = body.rlike(_HINT)
    none = F.array().cast("array<string>")
    found, values, parts = (free_name(docs, n) for n in ("_found", "_values", "_parts"))

    def replaced(x: Column) -> Column:
        value, kind = x["v"], x["kind"]
        new = F.lit(None).cast("string")
        for k in KINDS:
            new = F.when(kind == k, _RULES[k](value, key)).otherwise(new)
        return F.struct(kind.alias("kind"), value.alias("v"), new.alias("new"))

    staged = docs.withColumn(found, F.when(may, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(none))
    staged = staged.withColumn(values, F.transform(
        F.transform(F.col(found), lambda v: F.struct(v.alias("v"), _kind(v).alias("kind"))), replaced))
    shown = F.transform(F.col(values), lambda x: F.coalesce(x["new"], x["v"]))
    rebuilt = F.array_join(F.zip_with(F.split(body, ANY, -1), F.concat(shown, F.array(F.lit(""))), lambda g, v: F.concat(g, v)), "")
    new_text = F.when(F.size(found) > 0, rebuilt).otherwise(body)
    hits = F.filter(F.col(values), lambda x: x["new"].isNotNull())

    def count(kind: str) -> Column:
        return F.size(F.filter(hits, lambda x: x["kind"] == kind)).cast("long").alias(free_name(docs, f"n_{kind}"))

    kept = [new_text.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return staged.select(*kept, F.size(hits).cast("long").alias(free_name(docs, "n_values")), *[count(k) for k in KINDS])
