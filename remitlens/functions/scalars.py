"""Column → Column scalar functions (all built-in Spark expressions, codegen'd)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.schemas import MONEY

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Province lists used to pick a regional shard; anything else is SOUTH, a null
# province is CENTRAL.
NORTH_PROVINCES = [
    "Hà Nội", "Hải Phòng", "Bắc Ninh", "Hà Nam", "Hải Dương",
    "Hưng Yên", "Nam Định", "Ninh Bình", "Thái Bình", "Vĩnh Phúc",
]
MID_PROVINCES = [
    "Thanh Hóa", "Nghệ An", "Hà Tĩnh", "Quảng Bình", "Quảng Trị",
    "Thừa Thiên Huế", "Đà Nẵng", "Quảng Nam", "Quảng Ngãi", "Bình Định",
    "Phú Yên", "Khánh Hòa", "Ninh Thuận", "Bình Thuận", "Kon Tum",
    "Gia Lai", "Đắk Lắk", "Đắk Nông", "Lâm Đồng",
]
SUCCESS_STATUSES = ["SUCCESS", "COMPLETED"]
RISK_HIGH, RISK_MEDIUM, RISK_LOW = "CAO", "TRUNG_BINH", "THAP"
# The least value of each measure that makes a district's risk high, or medium.
HIGH_FAIL_RATE, HIGH_REVERSAL_RATE, HIGH_RAPID_FIRE, HIGH_FAN_OUT, HIGH_LARGE_AMOUNT = 20, 15, 1, 5, 1
MEDIUM_FAIL_RATE, MEDIUM_REVERSAL_RATE, MEDIUM_LARGE_AMOUNT, MEDIUM_FAN_OUT = 10, 5, 2, 2
UNKNOWN = "UNKNOWN"
# ---------------------------------------------------------------------------


def java_trim(c: Column) -> Column:
    """Strip leading/trailing characters <= U+0020 (Java String.trim).

    Most values are already clean, so the regex only runs when the first or
    last character is <= U+0020 (two one-character comparisons); a clean
    value passes through unchanged.
    """
    edge = (F.substring(c, 1, 1) <= F.lit(" ")) | (F.substring(c, -1, 1) <= F.lit(" "))
    return F.when(edge, F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")).otherwise(c)


def blank_to(c: Column, default: str) -> Column:
    """trim; null or blank → default."""
    t = java_trim(c)
    return F.when(t.isNull() | (t == ""), F.lit(default)).otherwise(t)


def status_norm(c: Column) -> Column:
    """trim + upper; null/blank → UNKNOWN."""
    return F.coalesce(F.nullif(F.upper(java_trim(c)), F.lit("")), F.lit(UNKNOWN))


def is_success(c: Column, statuses=SUCCESS_STATUSES) -> Column:
    return status_norm(c).isin(*statuses)


@lru_cache(maxsize=None)
def _latin_base_map() -> tuple[str, str]:
    """Precomposed Latin letters → their ASCII base letter, built by rule.

    Every code point in the Latin blocks whose canonical decomposition starts
    with an ASCII letter maps to that letter (the effect of NFD followed by
    removing combining marks); Đ/đ have no decomposition and map to D/d.
    """
    src, dst = [], []
    for cp in list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    src += ["Đ", "đ"]
    dst += ["D", "d"]
    return "".join(src), "".join(dst)


def _translate_non_ascii(c: Column, src: str, dst: str) -> Column:
    """``translate`` only where the value has a non-ASCII character: every
    mapped letter is non-ASCII, and ``translate`` looks each character up in a
    map, so ASCII-only values (most English text) skip it after one cheap scan."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, src, dst)).otherwise(c)


def normalize_location(c: Column) -> Column:
    """'Hà Nội' → 'HaNoi': strip accents, keep ASCII letters/whitespace, PascalCase-join.

    null/blank → 'Unknown'; a value with no letters left becomes ''.
    """
    src, dst = _latin_base_map()
    # Decomposed combining marks need no separate pass: like every other
    # non-ASCII character they fall to the [^a-zA-Z\s] removal.
    letters = F.regexp_replace(_translate_non_ascii(c, src, dst), r"[^a-zA-Z\s]+", "")
    # initcap lower-cases and starts a word after each ' ' only, so the other
    # whitespace characters become spaces; runs of spaces and the ends need no
    # collapsing or trimming because every space is removed afterwards.
    spaced = F.regexp_replace(letters, r"[\t\n\x0B\f\r]+", " ")
    pascal = F.replace(F.initcap(spaced), F.lit(" "), F.lit(""))
    blank = c.isNull() | c.rlike(r"^[\x00-\x20]*$")
    return F.when(blank, F.lit("Unknown")).otherwise(pascal)


@lru_cache(maxsize=None)
def vietnamese_letter_map() -> tuple[str, str]:
    """The Vietnamese accented letters and their ASCII letters, built by rule.

    Base vowels a ă â e ê i o ô ơ u ư y with the five tone marks (grave, hook,
    tilde, acute, dot below), plus ă â ê ô ơ ư themselves and đ, in both cases.
    """
    tones = ["̀", "̉", "̃", "́", "̣"]
    bases = ["a", "ă", "â", "e", "ê", "i", "o", "ô", "ơ", "u", "ư", "y"]
    src, dst = [], []
    for case in (str.lower, str.upper):
        for b in bases:
            plain = unicodedata.normalize("NFD", b)[0]
            if b != plain:
                src.append(case(b))
                dst.append(case(plain))
            for t in tones:
                src.append(case(unicodedata.normalize("NFC", b + t)))
                dst.append(case(plain))
        src.append(case("đ"))
        dst.append(case("d"))
    return "".join(src), "".join(dst)


def non_accent(c: Column) -> Column:
    src, dst = vietnamese_letter_map()
    return _translate_non_ascii(c, src, dst)


def region_of_province(c: Column) -> Column:
    return (F.when(c.isNull(), F.lit("CENTRAL"))
            .when(c.isin(*NORTH_PROVINCES), F.lit("NORTH"))
            .when(c.isin(*MID_PROVINCES), F.lit("MID"))
            .otherwise(F.lit("SOUTH")))


def normalize_group_by(group_by: str | None) -> str:
    g = str(group_by).strip().lower()
    return g if g in ("month", "quarter", "year") else "day"


def period_label(ts: Column, group_by: str | None) -> Column:
    """yyyy-MM-dd / MM/yyyy / Qn/yyyy / yyyy; null time → 'Không rõ'."""
    g = normalize_group_by(group_by)
    if g == "month":
        label = F.date_format(ts, "MM/yyyy")
    elif g == "quarter":
        label = F.concat(F.lit("Q"), F.quarter(ts).cast("string"), F.lit("/"), F.year(ts).cast("string"))
    elif g == "year":
        label = F.date_format(ts, "yyyy")
    else:
        label = F.date_format(ts, "yyyy-MM-dd")
    return F.when(ts.isNull(), F.lit("Không rõ")).otherwise(label)


def period_start(ts: Column, group_by: str | None) -> Column:
    g = normalize_group_by(group_by)
    unit = {"day": "day", "month": "month", "quarter": "quarter", "year": "year"}[g]
    return F.date_trunc(unit, ts)


def quarter_of(ts: Column) -> Column:
    """'Q1'..'Q4'."""
    return F.concat(F.lit("Q"), F.quarter(ts).cast("string"))


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def ts_parse(c: Column, strict: bool = False) -> Column:
    """ISO local date-time → timestamp_ntz; bad values → NULL (the row is skipped).

    ``strict`` accepts only yyyy-MM-dd'T'HH:mm:ss (no missing seconds, no fraction).
    """
    t = java_trim(c)
    if strict:
        return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"),
                      F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss"))).cast("timestamp_ntz")
    iso = t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$")
    return F.when(iso, t.try_cast("timestamp_ntz"))


def amount_parse(c: Column) -> Column:
    """Text → decimal(18,2); unparsable → NULL."""
    return java_trim(c).try_cast(MONEY)


def round2_java(x: Column) -> Column:
    """Math.round(x*100)/100: half-up toward +infinity (Spark's round differs on negative ties)."""
    return F.floor(x * 100 + F.lit(0.5)) / 100.0


def pct2_java(numerator: Column, denominator: Column) -> Column:
    """Math.round(num * 10000.0 / den) / 100.0 — a percentage with 2 decimals."""
    return F.floor(numerator.cast("double") * 10000.0 / denominator + F.lit(0.5)) / 100.0


def money_format(amount: Column) -> Column:
    """'%,.0f VND' — half-up to whole units, grouped thousands; null → '0 VND'."""
    rounded = F.round(amount.cast(MONEY), 0)
    return F.when(amount.isNull(), F.lit("0 VND")).otherwise(
        F.concat(F.format_number(rounded, 0), F.lit(" VND")))


def risk_level(fail_rate: Column, reversal_rate: Column, rapid_fire: Column,
               fan_out: Column, large_amount: Column) -> Column:
    high = ((fail_rate >= HIGH_FAIL_RATE) | (reversal_rate >= HIGH_REVERSAL_RATE) | (rapid_fire >= HIGH_RAPID_FIRE)
            | (fan_out >= HIGH_FAN_OUT) | (large_amount >= HIGH_LARGE_AMOUNT))
    medium = ((fail_rate >= MEDIUM_FAIL_RATE) | (reversal_rate >= MEDIUM_REVERSAL_RATE)
              | (large_amount >= MEDIUM_LARGE_AMOUNT) | (fan_out >= MEDIUM_FAN_OUT))
    return F.when(high, F.lit(RISK_HIGH)).when(medium, F.lit(RISK_MEDIUM)).otherwise(F.lit(RISK_LOW))


def risk_score(level: Column) -> Column:
    return F.when(level == RISK_HIGH, 3).when(level == RISK_MEDIUM, 2).otherwise(1)


def json_unwrap(value: Column) -> Column:
    """An event value may be JSON, or a JSON string that itself holds JSON."""
    wrapped = value.startswith('"') & value.endswith('"')
    inner = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>").getItem(0)
    return F.when(wrapped, inner).otherwise(value)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def day_of(ts: Column) -> Column:
    return F.dayofmonth(ts)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00 - %02d:59", hour, hour)


def day_label(day: Column) -> Column:
    return F.format_string("Ngày %02d", day)
