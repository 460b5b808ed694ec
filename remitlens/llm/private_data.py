"""Personal data in texts (operator 13).

Regular expressions propose spans, checksums (Luhn, modulo 97) and ranges
confirm them, and words around a span raise its score. Built from DataFrame
functions only, row by row.

Every pattern is written so that a text is searched in time proportional to
its length: it can only begin where a run of its letters begins, and it gives
nothing back once it has matched (possessive repeats). Where a span lies is
read off the lengths of the pieces between the matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four kinds of spans that are always reported, and their patterns.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Proposals beyond them: bank accounts, social security numbers and telephone numbers without a country code.
# They are only taken between letters that don't continue them (``EDGES``: not before, not after).
IBAN = r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
LOCAL = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}"
EDGES = {"iban": ("[A-Za-z0-9]", "[A-Za-z0-9]"), "ssn": ("[A-Za-z0-9-]", "[A-Za-z0-9-]"),
         "local": ("[A-Za-z0-9+(-]", "[A-Za-z0-9-]")}
_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
AROUND = 40  # code points on either side in which a context word counts


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a text it can't be without, its context words,
    whether it is reported whatever its score, the score of a match, and what the
    check's confirmation and a context word add to it."""

    name: str
    pattern: str
    needs: str
    words: str
    base: bool
    score: float
    confirmed: float
    context: float


KINDS = [
    Kind("email", EMAIL, "@", "e-?mail|mail|contact|write", True, 0.6, 0.2, 0.2),
    Kind("ip", IP, ".", "ip|address|server|host", True, 0.3, 0.3, 0.3),
    Kind("card", CARD, "", "card|credit|debit|visa|payment|account", True, 0.2, 0.5, 0.3),
    Kind("phone", PHONE, "+", "phone|tel|telephone|call|mobile|fax", True, 0.4, 0.3, 0.3),
    Kind("iban", IBAN, "", "iban|bank|account|transfer", False, 0.1, 0.6, 0.3),
    Kind("ssn", SSN, "-", "ssn|social security", False, 0.1, 0.2, 0.4),
    Kind("local", LOCAL, "", "phone|tel|telephone|call|mobile|fax", False, 0.2, 0.1, 0.4),
]
LEAST_SCORE = 0.5


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether the digits pass the Luhn sum: from the right, every second digit doubled."""
    digits = F.split(F.reverse(_digits(text)), "")
    doubled = F.transform(digits, lambda d, i: _bound(
        d.cast("int") * (i % 2 + 1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def _mod_97(text: Column) -> Column:
    """Whether the account's check digits hold: first four letters to the end,
    letters as 10 to 35, the number modulo 97 is 1."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c < "A", c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return rest == 1


def _passes(kind: Kind, text: Column) -> Column:
    if kind.name == "ip":
        return text.rlike("^" + r"\.".join([_PART] * 4) + "$")
    if kind.name == "card":
        return _luhn(text)
    if kind.name == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind.name == "iban":
        return _mod_97(text)
    if kind.name == "ssn":  # areas, groups and numbers that are never given
        return ~text.rlike("^(000|666|9)") & ~text.rlike("-00-|-0000$")
    return F.lit(True)


def _before(sizes: Column) -> Column:
    """For each size (of a computed array) the sum of all earlier ones. Sums of stretches first, then
    inside a stretch, so the work is n^(4/3) for n sizes and not n^2."""

    def total(values):
        return F.aggregate(values, F.lit(0), lambda a, v: a + v)

    def stretches(width):
        first = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / width).cast("int"))
        sums = F.transform(first, lambda s: total(F.slice(sizes, s * width + 1, width)))
        return _bound(sums, lambda each: _bound(
            F.transform(first, lambda s: total(F.slice(each, F.lit(1), s))),
            lambda starts: F.flatten(F.transform(first, lambda s: _bound(
                F.slice(sizes, s * width + 1, width), lambda own: F.transform(
                    own, lambda _, i: F.get(starts, s) + total(F.slice(own, F.lit(1), i))))))))

    width = F.greatest(F.ceil(F.cbrt(F.size(sizes).cast("double"))), F.lit(1)).cast("int")
    return F.when(F.size(sizes) == 0, F.array().cast("array<int>")).otherwise(_bound(width, stretches))


_SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _spans(text: Column, kind: Kind) -> Column:
    """The spans of one kind: proposals that pass the check (other kinds than
    the base ones also need the score ``LEAST_SCORE``), by start."""
    empty = F.array().cast(f"array<{_SPAN}>")
    words = f"(?i)(^|[^A-Za-z])({kind.words})([^A-Za-z]|$)"

    def placed(pieces, found):
        sizes = F.transform(found, lambda m, i: F.char_length(F.get(pieces, i)) + F.char_length(m))

        def spans(ends_before):
            each = F.transform(found, lambda m, i: _bound(
                F.get(ends_before, i) + F.char_length(F.get(pieces, i)), lambda start: F.struct(
                    F.lit(kind.name).alias("kind"), start.alias("start"),
                    (start + F.char_length(m)).alias("end"), scored(pieces, found, m, i).alias("score"))))
            return F.filter(each, lambda s: s["score"].isNotNull())

        return _bound(_bound(sizes, _before), spans)

    def scored(pieces, found_, m, i):
        edge_free = F.lit(True)
        if kind.name in EDGES:
            last = F.right(F.concat(F.coalesce(F.get(found_, i - 1), F.lit("")), F.get(pieces, i)), F.lit(1))
            next_ = F.left(F.concat(F.get(pieces, i + 1), F.coalesce(F.get(found_, i + 1), F.lit(""))), F.lit(1))
            edge_free = ~last.rlike(EDGES[kind.name][0]) & ~next_.rlike(EDGES[kind.name][1])
        near = F.concat_ws(" ", F.right(F.get(pieces, i), F.lit(AROUND)), F.left(F.get(pieces, i + 1), F.lit(AROUND)))
        sum_ = F.round(F.lit(kind.score + kind.confirmed)
                       + F.when(near.rlike(words), kind.context).otherwise(0.0), 2)
        enough = F.lit(True) if kind.base else sum_ >= LEAST_SCORE
        return F.when(edge_free & _passes(kind, m) & enough, sum_)

    def search(t):
        found = F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))
        return _bound(found, lambda f: F.when(F.size(f) == 0, empty).otherwise(
            _bound(F.split(t, kind.pattern, -1), lambda pieces: placed(pieces, f))))

    return F.when(F.contains(text, F.lit(kind.needs)), search(text)).otherwise(empty)


def _apart(extra: Column, base: Column) -> Column:
    """The spans of ``extra`` that share no letter with one of ``base``."""
    return F.filter(extra, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of personal data in each whole text.

    ``base_spans``: e-mail and IP addresses, card numbers (Luhn) and telephone
    numbers with a country code, whatever their score. ``spans``: these, then
    bank accounts (modulo 97), social security numbers and other telephone
    numbers that reach ``LEAST_SCORE`` with their confirmation and the words
    around them and that touch no base span. A span is (kind, start, end,
    score), in code points, end exclusive, ordered by kind as in ``KINDS`` and
    then by start; matches of one kind don't overlap.

    Context words count within ``AROUND`` code points and up to the next match of
    the kind. A null or empty text has no spans. Repeated rows, null keys, an
    empty table and texts of any length need nothing more; older columns named
    ``base_spans`` and ``spans`` are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    each = docs.withColumns({f"__{k.name}": _spans(whole, k) for k in KINDS})
    base = F.concat(*[F.col(f"__{k.name}") for k in KINDS if k.base])
    extra = F.concat(*[F.col(f"__{k.name}") for k in KINDS if not k.base])
    return each.withColumn("base_spans", base).withColumn("spans", F.concat("base_spans", F.when(
        F.size(extra) == 0, extra).otherwise(_apart(extra, F.col("base_spans"))))).drop(*[f"__{k.name}" for k in KINDS])


def count_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
