"""Format-preserving pseudonyms for personal data.

Candidates are found by patterns and validated (Luhn sum, IBAN checksum,
calendar, address and number ranges). A valid value is read as a row of
digits, each with its own radix, and sent through a keyed Feistel network:
round by round the digits at even (odd) places are shifted by amounts drawn
from a keyed hash of the digits at the other places. That is a permutation
of the format, so the pseudonym is a value of the same format, two equal
values have one pseudonym in every document, and two different values never
share one. Check digits are computed anew.

Everything is built-in functions on one row: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Formats searched for, tried in this order at each place of a text where no
# word goes on. The repeats are possessive or bounded, so that long texts cost
# linear time.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])(?=[A-Fa-f]*+\d)(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w+.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])",
    # a whole run of digit groups: the cards in it are found by _scanned
    "card": r"(?<![\w.-])(?=\d(?:[ -]?\d){12})\d++(?!\w)(?:[ -]\d++(?!\w))*+",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]|\.\d)",
}


def _search(*without: str) -> str:
    return r"(?<!\w)(?:" + "|".join(f"(?:{p})" for name, p in FORMATS.items() if name not in without) + ")"


#: The searches, one after the other: what the first leaves of a card's or an
#: IBAN's match, and the text around it, is searched again, as another value
#: may begin there.
PATTERNS = [_search(), _search("card"), _search("iban")]
#: What every value of any format has.
SIGN = "[0-9@]"

# Date formats, and the 400-year calendar cycle they are permuted in: from
# 1700-01-01, 146,097 = 189 x 773 days.
_DATES = ("yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy")
_DAY_0, _DAYS = "1700-01-01", (189, 773)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(digits: Column, radix: Column, key: str, tweak: str, inverse: bool = False) -> Column:
    """A keyed permutation of the rows of ``digits`` (array<long>) below
    ``radix`` (array<long>, same size)."""

    def one_round(v: Column, k: Column) -> Column:
        other = F.array_join(F.transform(F.filter(v, lambda x, i: (i + k) % 2 == 1), lambda x: x.cast("string")), ",")
        mark = F.sha2(F.concat(F.lit(f"{key}|{tweak}|"), k.cast("string"), F.lit("|"), other), 256)

        def shifted(d: Column) -> Column:
            def at(x: Column, i: Column) -> Column:
                draw = F.conv(F.substring(d, i * 7 % 57 + 1, F.lit(7)), 16, 10).cast("long")
                moved = x - draw if inverse else x + draw
                return F.when((i + k) % 2 == 0, F.pmod(moved, F.element_at(radix, i + 1))).otherwise(x)

            return F.transform(v, at)

        return _let(mark, shifted)

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(order, digits, one_round)


_DIGITS, _LETTERS, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"


def permute_chars(s: Column, key: str, tweak: str, hexadecimal: bool = False, inverse: bool = False) -> Column:
    """The string with its digits and ASCII letters (or hexadecimal digits)
    permuted among their own kind; case and other characters stay in place."""

    def run(s: Column) -> Column:
        chars = F.split(s, "")

        def value(c: Column) -> Column:
            low = F.lower(c)
            if hexadecimal:
                return F.greatest(F.position(low, F.lit(_HEX)) - 1, F.lit(0)).cast("long")
            return (
                F.when(c.rlike("[0-9]"), F.position(c, F.lit(_DIGITS)) - 1)
                .when(c.rlike("[A-Za-z]"), F.position(low, F.lit(_LETTERS)) - 1).otherwise(0).cast("long")
            )

        def size(c: Column) -> Column:
            if hexadecimal:
                return F.lit(16).cast("long")
            return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).cast("long")

        def written(c: Column, v: Column) -> Column:
            if hexadecimal:
                out = F.substring(F.lit(_HEX), v.cast("int") + 1, F.lit(1))
                return F.when(c.rlike("[A-F]"), F.upper(out)).otherwise(out)
            letter = F.substring(F.lit(_LETTERS), v.cast("int") + 1, F.lit(1))
            return (
                F.when(c.rlike("[0-9]"), v.cast("string")).when(c.rlike("[a-z]"), letter)
                .when(c.rlike("[A-Z]"), F.upper(letter)).otherwise(c)
            )

        new = feistel(F.transform(chars, value), F.transform(chars, size), key, tweak, inverse)
        out = F.array_join(F.zip_with(chars, new, written), "")
        # hexadecimal runs share one case, which the letters alone can't keep
        return F.when(s.rlike("[A-F]"), F.upper(out)).otherwise(F.lower(out)) if hexadecimal else out

    return _let(s, run)


def _bare(m: Column) -> Column:
    return F.regexp_replace(m, "[^A-Za-z0-9]", "")


def _refill(shape: Column, bare: Column) -> Column:
    """``shape`` with its letters and digits replaced by those of ``bare`` in
    order: one value written with other separators keeps its pseudonym."""
    def at(c: Column, i: Column) -> Column:
        nth = F.length(_bare(F.substring(shape, F.lit(1), i + 1)))
        return F.when(c.rlike("[A-Za-z0-9]"), F.substring(bare, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), at), "")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a digit string, its last digit doubled or not."""
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    at = 0 if double_last else 1
    part = F.transform(reverse, lambda d, i: F.when(i % 2 == at, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(part, F.lit(0), lambda a, d: a + d)


def _mod97(code: Column) -> Column:
    """An IBAN's code (check part moved to the end, letters as 10 to 35) mod 97."""
    def step(a: Column, c: Column) -> Column:
        v = F.position(c, F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1
        return (a * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.split(code, ""), F.lit(0), step)


def _radix(*sizes: int) -> Column:
    return F.array(*[F.lit(s).cast("long") for s in sizes])


def _card(m: Column, key: str) -> Column:
    digits = _bare(m)

    def closed(new: Column) -> Column:
        check = F.pmod(-_luhn_sum(new, True), F.lit(10))
        return _refill(m, F.concat(new, check.cast("string")))

    new = permute_chars(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    return F.when(_luhn_sum(digits, False) % 10 == 0, _let(new, closed)).otherwise(m)


def _iban(m: Column, key: str) -> Column:
    bare = _bare(m)
    land, rest = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
    valid = _mod97(F.concat(rest, F.substring(bare, 1, 4))) == 1

    def closed(new: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0")
        return _refill(m, F.concat(land, check, new))

    return F.when(valid, _let(permute_chars(rest, key, "iban"), closed)).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    area = F.substring(m, 1, 3).cast("long")
    index = area - 1 - F.when(area > 666, 1).otherwise(0)  # 1 to 899 without 666
    v = F.array(index, F.substring(m, 5, 2).cast("long") - 1, F.substring(m, 8, 4).cast("long") - 1)

    def written(d: Column) -> Column:
        a = F.element_at(d, 1) + 1
        return F.concat_ws(
            "-", F.lpad((a + F.when(a >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((F.element_at(d, 2) + 1).cast("string"), 2, "0"), F.lpad((F.element_at(d, 3) + 1).cast("string"), 4, "0"),
        )

    return _let(feistel(v, _radix(898, 99, 9999), key, "ssn"), written)


def _ip(m: Column, key: str) -> Column:
    v = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    new = feistel(v, _radix(256, 256, 256, 256), key, "ip")
    return F.array_join(F.transform(new, lambda x: x.cast("string")), ".")


def _date(m: Column, key: str) -> Column:
    out = m
    for fmt in _DATES:
        day = F.try_to_timestamp(m, F.lit(fmt)).cast("date")
        at = F.datediff(day, F.lit(_DAY_0).cast("date")).cast("long")
        a, b = _DAYS
        new = feistel(F.array(F.floor(at / b), at % b), _radix(a, b), key, "date")

        def written(d: Column) -> Column:
            moved = F.date_add(F.lit(_DAY_0).cast("date"), (F.element_at(d, 1) * b + F.element_at(d, 2)).cast("int"))
            return F.date_format(moved, fmt)

        shape = "^" + "".join({"y": r"\d", "M": r"\d", "d": r"\d", ".": r"\."}.get(c, c) for c in fmt) + "$"
        inside = (at >= 0) & (at < a * b)
        out = F.when(m.rlike(shape), F.when(F.coalesce(inside, F.lit(False)), _let(new, written)).otherwise(m)).otherwise(out)
    return out


def _phone(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])", 0)  # the country code stays
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    return F.concat(head, _let(permute_chars(_bare(rest), key, "phone"), lambda new: _refill(rest, new)))


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(permute_chars(name, key, "email"), F.substring(m, F.length(name) + 1, F.length(m)))


_PSEUDONYMS = {
    "email": _email, "iban": _iban, "hex": lambda m, key: permute_chars(m, key, "hex", hexadecimal=True),
    "phone": _phone, "ssn": _ssn, "card": _card, "ip": _ip, "date": _date,
}


def _piece(text: Column, value: bool) -> Column:
    """A part of a text: plain, or a pseudonym."""
    return F.struct(text.alias("text"), F.lit(value).alias("value"))


def _either(old: Column, new: Column) -> Column:
    return F.when(old == new, F.array(_piece(old, False))).otherwise(F.array(_piece(new, True)))


#: Groups of characters that ``_scanned`` handles at a time. What it has found
#: is appended once per block, so a run of any length costs about linear time.
BLOCK = 128


def _scanned(m: Column, replaced) -> Column:
    """Pieces of a match that other groups of characters may have joined: from
    each group on, the longest run of whole groups that ``replaced`` changes
    is a value."""
    groups = F.split(m, "(?=[ -])")  # each but the first begins with its separator

    def scan(groups: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            group = F.element_at(groups, i)
            sign = F.when(i > 1, F.substring(group, 1, 1)).otherwise("")

            def candidate(j: Column) -> Column:
                text = F.array_join(F.slice(groups, i, j - i + 1), "")
                old = F.substring(text, F.length(sign) + 1, F.length(text))
                return _let(old, lambda c: F.struct(c.alias("old"), replaced(c).alias("new"), (j + 1).alias("next")))

            ends = F.sequence(F.least(i + 18, F.size(groups)), i, F.lit(-1))
            found = F.get(F.filter(F.transform(ends, candidate), lambda c: c["old"] != c["new"]), F.lit(0))

            def taken(c: Column) -> Column:
                value = F.array(_piece(sign, False), _piece(c["new"], True))
                return F.struct(
                    F.coalesce(c["next"], i + 1).alias("next"),
                    F.concat(state["out"], F.when(c.isNotNull(), value).otherwise(F.array(_piece(group, False)))).alias("out"),
                )

            return F.when(i < state["next"], state).otherwise(_let(found, taken))

        def block(state: Column, first: Column) -> Column:
            own = F.sequence(first, F.least(first + BLOCK - 1, F.size(groups)))
            start = F.struct(state["next"].alias("next"), F.array().cast(_PIECES).alias("out"))
            return _let(
                F.aggregate(own, start, step),
                lambda s: F.struct(s["next"].alias("next"), F.concat(state["out"], F.array(s["out"])).alias("out")),
            )

        start = F.struct(F.lit(1).alias("next"), F.array().cast(f"array<{_PIECES}>").alias("out"))
        firsts = F.sequence(F.lit(1), F.size(groups), F.lit(BLOCK))
        return F.flatten(F.aggregate(firsts, start, block, lambda state: state["out"]))

    return _let(groups, scan)


_PIECES = "array<struct<text:string,value:boolean>>"


def _pieces(m: Column, key: str) -> Column:
    """The pieces of a match."""
    def card(c: Column) -> Column:
        return F.when(F.length(_bare(c)).between(13, 19), _card(c, key)).otherwise(c)

    def iban(c: Column) -> Column:
        form = c.rlike("^[A-Z]{2}[0-9]{2}") & F.length(_bare(c)).between(12, 35)
        return F.when(form, _iban(c, key)).otherwise(c)

    out = F.when(m.rlike(f"^(?:{FORMATS['email']})$"), _either(m, _email(m, key)))
    out = out.when(m.rlike(f"^(?:{FORMATS['iban']})$"), _scanned(m, iban))
    for name, pattern in FORMATS.items():
        if name not in ("email", "iban"):
            new = _scanned(m, card) if name == "card" else _let(_PSEUDONYMS[name](m, key), lambda new: _either(m, new))
            out = out.when(m.rlike(f"^(?:{pattern})$"), new)
    return out.otherwise(F.array(_piece(m, False)))


def _cut(text: Column, key: str, pattern: str) -> Column:
    """The pieces of a text."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: _pieces(m, key))
    # the text between the matches, one part more than there are matches
    parts = F.split(text, pattern, -1)
    none = F.array().cast(_PIECES)
    return F.flatten(F.zip_with(parts, found, lambda p, f: F.concat(F.array(_piece(p, False)), F.coalesce(f, none))))


def _turns(pieces: Column, mark: Column) -> Column:
    """Plain text and pseudonyms by turns (plain text first and last, perhaps
    empty): neighbouring plain pieces become one, in one pass over all.
    ``mark`` is a text that stands in no piece."""
    def run(pieces: Column) -> Column:
        plain = F.split(F.array_join(F.transform(pieces, lambda p: F.when(p["value"], mark).otherwise(p["text"])), ""), mark, -1)
        values = F.transform(F.filter(pieces, lambda p: p["value"]), lambda p: p["text"])
        return F.flatten(F.zip_with(plain, values, lambda p, v: F.when(v.isNull(), F.array(p)).otherwise(F.array(p, v))))

    return _let(pieces, run)


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every valid e-mail address, IBAN, long hexadecimal
    secret, telephone, social security and card number, IPv4 address and date
    of the whole text replaced by its pseudonym under the secret ``key``; adds
    ``n_pseudonyms`` (int: values replaced).

    Numbers that fail validation (a Luhn sum, say) stay; other groups of
    characters next to a valid number, with one blank or hyphen between, do
    not hide it. A null text stays null with 0 values; repeated rows are
    alike; an empty table gives an empty result; a column named n_pseudonyms
    is replaced.
    """
    rows = docs.drop("n_pseudonyms")
    # a text of its own hash is not in the text; texts without a sign of any
    # value are spared the patterns
    signed = F.col(text).rlike(SIGN)
    rows = rows.withColumn("_mark", F.when(signed, F.sha2(F.concat(F.lit(f"{key}|mark|"), F.col(text)), 256)))
    rows = rows.withColumn("_pieces", F.when(signed, _turns(_cut(F.col(text), key, PATTERNS[0]), F.col("_mark"))))
    grouped = F.col(text).rlike(f"(?:{FORMATS['card']})|(?:{FORMATS['iban']})")
    for pattern in PATTERNS[1:]:
        again = F.flatten(F.transform(
            F.col("_pieces"), lambda x, i: F.when(i % 2 == 0, _cut(x, key, pattern)).otherwise(F.array(_piece(x, True)))
        ))
        turns = _turns(again, F.col("_mark"))
        rows = rows.withColumn("_pieces", F.when(F.col("_pieces").isNotNull() & grouped, turns).otherwise(F.col("_pieces")))
    changed = F.floor(F.size("_pieces") / 2).cast("int")
    return rows.withColumn("n_pseudonyms", F.when(F.col("_pieces").isNull(), 0).otherwise(changed)).withColumn(
        text, F.when(F.col("_pieces").isNull(), F.col(text)).otherwise(F.array_join("_pieces", ""))
    ).drop("_pieces", "_mark")
