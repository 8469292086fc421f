"""Format-preserving pseudonyms for personal data in texts.

Numbers and dates that pass validation are permuted within their own format by
a keyed Feistel network: a card number becomes another one with a right check
digit, an address another address, a date another date. The map is one-to-one
and depends on the key alone, so equal values stay equal in all documents and
different ones stay different. What fails validation is left alone.

Found and checked:

* card numbers of 13 to 19 digits, in one run, in groups of four, or in groups
  of 4, 6 and 4 or 5: Luhn digit
* IPv4 addresses: octets up to 255
* phone numbers with ``+`` and 8 to 15 digits, single separators or brackets
  between any of them, or in North American form
* social security numbers: area, group and serial in use
* IBANs: check digits modulo 97
* dates as 2024-01-31, 31.1.2024 and 1/31/2024: days that exist; 31/1/2024,
  which can only have the day first, becomes another date like that
* e-mail addresses: by form; the name gets a keyed name, the domain stays

The network works on a pair (left, right) below (a, b) by adding, modulo a and
b in turn, a keyed hash of the other half, so that its domain has exactly a * b
values and no value needs another round. All of it is Spark's own functions.

Texts: NULL stays NULL, texts without values stay as they are, of any length.
Every row gets its own result, repeated ones the same. Columns of any other
name are kept; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Dates are permuted within stretches of 200 * 365 days from this day on.
_DATE_PARTS = (200, 365)
_FIRST_DAY = "0001-01-01"

# Repeated groups of open length are possessive: no long run of characters is
# tried more than once, and the engine loops over them instead of recursing.
# The last label of a domain that is made of letters ends an address.
_LAST = r"[A-Za-z]{2,}+(?![\w-])"
EMAIL = rf"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.(?:(?!{_LAST})[A-Za-z0-9-]++\.)*+{_LAST})++"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<!\w)(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = (
    r"(?<!\w)(?<!\d\.)(?:\d{13,19}|\d{4}(?<gap>[ -])(?:\d{4}\k<gap>\d{4}\k<gap>\d{1,7}|\d{6}\k<gap>\d{4,5}))(?!\w|\.\d)"
)
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
DAY_DATE = r"(?<![\w./])\d{1,2}\.\d{1,2}\.\d{4}(?!\w|[./]\d)"
MONTH_DATE = r"(?<![\w./])\d{1,2}/\d{1,2}/\d{4}(?!\w|[./]\d)"
# What follows a phone number after a blank, and is no part of it.
_OTHER = rf"(?:{IPV4}|{SSN}|{ISO_DATE}|{DAY_DATE}|{MONTH_DATE}|\d{{4}}[ -]\d{{4}}[ -]\d{{4}}[ -]|\d{{4}}[ -]\d{{6}}[ -]\d)"
PHONE = (
    r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    rf"|(?<![\w+])\+\d(?:(?:[ .-](?!{_OTHER}))?\(?\d\)?){{7,14}}(?!\d)"
    r"|(?<![\w+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\w)"
)


# What a value can begin with is looked at first.
_NUMBERS = "|".join((IPV4, SSN, ISO_DATE, CARD, DAY_DATE, MONTH_DATE))
ANY = rf"{EMAIL}|(?=[0-9+(A-Z])(?:(?=\d)(?:{_NUMBERS})|{PHONE}|{IBAN})"


def _hashed(key: str, tag: str, turn: Column, half: Column, modulus: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), modulus.cast("string"), half.cast("string"))
    # 60 bits of the digest.
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), modulus)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """The permuted pair as struct (l, r): a bijection on [0, a) x [0, b)."""

    def turn(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(l + _hashed(key, tag, i, r, a), a)).otherwise(l).alias("l"),
            F.when(even, r).otherwise(F.pmod(r + _hashed(key, tag, i, l, b), b)).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    """10 ** n for n up to 18."""
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def permuted_digits(digits: Column, key: str, tag: str) -> Column:
    """Another string of as many digits, for 2 to 36 of them."""
    n = F.length(digits)
    cut = F.floor(n / 2).cast("int")
    pair = feistel(
        F.substr(digits, F.lit(1), cut).cast("long"),
        F.substr(digits, cut + 1).cast("long"),
        _power(cut),
        _power(n - cut),
        key,
        tag,
    )
    return _with(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), cut, "0"), F.lpad(p["r"].cast("string"), n - cut, "0")))


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order."""

    def step(state: Column, char: Column) -> Column:
        is_digit = char.between("0", "9")
        new = F.substr(digits, state["i"] + 1, F.lit(1))
        return F.struct(
            F.concat(state["out"], F.when(is_digit, new).otherwise(char)).alias("out"),
            (state["i"] + F.when(is_digit, 1).otherwise(0)).alias("i"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))
    return F.aggregate(F.split(value, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right but one doubled,
    with both digits of a double counted."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    other = _with(permuted_digits(payload, key, "card"), lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
    return F.when((F.length(digits) >= 13) & (luhn_sum(digits) % 10 == 0), _with(other, lambda d: _refilled(value, d)))


def _ipv4(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    high = F.element_at(octets, 1) * 256 + F.element_at(octets, 2)
    low = F.element_at(octets, 3) * 256 + F.element_at(octets, 4)
    size = F.lit(65536).cast("long")

    def show(p: Column) -> Column:
        parts = [p["l"], p["r"]]
        return F.concat_ws(".", *(x.cast("string") for h in parts for x in (F.floor(h / 256), h % 256)))

    return _with(feistel(high, low, size, size, key, "ipv4"), show)


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    # The country code stays: it is what stands before the first separator.
    # Without a separator only one digit is kept.
    code = F.regexp_extract(value, r"^\+(\d{1,3})(?=[ .(-])", 1)
    kept = F.when(~value.startswith("+"), 0).when(code != "", F.length(code)).otherwise(1)
    rest = F.substr(digits, kept + 1)
    other = F.concat(F.substr(digits, F.lit(1), kept), permuted_digits(rest, key, "phone"))
    return F.when(F.length(digits).between(8, 15), _with(other, lambda d: _refilled(value, d)))


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (p.cast("long") for p in (F.substring(value, 1, 3), F.substring(value, 5, 2), F.substring(value, 8, 4)))
    used = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    # 898 areas, 99 groups, 9999 serials.
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "ssn")

    def show(p: Column) -> Column:
        at = F.floor(p["l"] / 99)
        number = F.when(at >= 665, at + 2).otherwise(at + 1)
        return F.concat_ws("-", *(F.lpad(x.cast("string"), n, "0") for x, n in ((number, 3), (p["l"] % 99 + 1, 2), (p["r"] + 1, 4))))

    return F.when(used, _with(pair, show))


def _mod97(text: Column) -> Column:
    """The remainder of a text whose letters stand for 10 to 35."""

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5))
    ok = F.length(plain).between(15, 34) & (_mod97(F.concat(account, F.substring(plain, 1, 4))) == 1)
    digits = _digits(account)

    def show(d: Column) -> Column:
        other = _refilled(account, d)
        check = F.lpad((98 - _mod97(F.concat(other, country, F.lit("00")))).cast("string"), 2, "0")
        # Digits in the order of the text: check digits, then the account's.
        return _refilled(value, F.concat(check, d))

    return F.when(ok & (F.length(digits) >= 2), _with(permuted_digits(digits, key, "iban"), show))


def _permuted_day(day: Column, key: str) -> Column:
    a, b = _DATE_PARTS
    number = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("long")
    block, within = F.floor(number / (a * b)), number % (a * b)
    # The stretch that reaches past the year 9999 has no room to permute in.
    day = F.when(block < 50, day)
    pair = feistel(F.floor(within / b), within % b, F.lit(a).cast("long"), F.lit(b).cast("long"), key, "date")
    return F.when(day.isNotNull(), _with(pair, lambda p: F.date_add(F.lit(_FIRST_DAY).cast("date"), (block * (a * b) + p["l"] * b + p["r"]).cast("int"))))


def _permuted_late_day(day: Column, key: str) -> Column:
    """Another date after the 12th of its month. Months of one length are
    permuted with their days in stretches of 200 years; February 29ths, with
    each other."""
    year, month, number = F.year(day).cast("long"), F.month(day), F.dayofmonth(day).cast("long")
    stretch = F.floor((year - 1) / 200)
    # The last stretch ends in 9999.
    years = F.when(stretch == 49, 199).otherwise(200).cast("long")

    def among(months: tuple[int, ...]) -> Column:
        listed, n, last = F.array(*map(F.lit, months)), len(months), 28 if months == (2,) else 31 if 1 in months else 30
        left = (year - 1) % 200 * n + F.array_position(listed, month) - 1
        pair = feistel(left, number - 13, years * n, F.lit(last - 12).cast("long"), key, f"day{last}")
        return _with(
            pair,
            lambda p: F.make_date(
                (stretch * 200 + 1 + F.floor(p["l"] / n)).cast("int"), F.element_at(listed, (p["l"] % n + 1).cast("int")), (p["r"] + 13).cast("int")
            ),
        )

    # Leap years from 1 to 9999: 24 times 101.
    leap = F.filter(F.sequence(F.lit(4), F.lit(9996), F.lit(4)), lambda y: (y % 100 != 0) | (y % 400 == 0))
    place = F.array_position(leap, F.year(day)) - 1
    a, b = (F.lit(n).cast("long") for n in (24, 101))
    leaps = feistel(F.floor(place / b), place % b, a, b, key, "leap day")
    other = _with(leaps, lambda p: F.make_date(F.element_at(leap, (p["l"] * b + p["r"] + 1).cast("int")), F.lit(2), F.lit(29)))
    return (
        F.when((month == 2) & (number == 29), other)
        .when(month == 2, among((2,)))
        .when(month.isin(4, 6, 9, 11), among((4, 6, 9, 11)))
        .otherwise(among((1, 3, 5, 7, 8, 10, 12)))
    )


def _day(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL if there is none."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _date(value: Column, key: str) -> Column:
    parts = F.split(value, r"[-./]")
    one, two, three = (F.element_at(parts, i) for i in (1, 2, 3))
    padded = (F.length(one) > 1) & (F.length(two) > 1)

    def shown(day: Column, wide: str, narrow: str, permuted=_permuted_day) -> Column:
        new = permuted(day, key)
        return F.when(padded, F.date_format(new, wide)).otherwise(F.date_format(new, narrow))

    iso, dotted = _day(one, two, three), _day(three, two, one)
    by_month = _day(three, one, two)
    return (
        F.when(value.contains("-"), F.date_format(_permuted_day(iso, key), "yyyy-MM-dd"))
        .when(value.contains("."), shown(dotted, "dd.MM.yyyy", "d.M.yyyy"))
        .when(by_month.isNotNull(), shown(by_month, "MM/dd/yyyy", "M/d/yyyy"))
        # No month has this number, so the day is first, and stays above 12.
        .otherwise(F.when(dotted.isNotNull(), shown(dotted, "dd/MM/yyyy", "d/M/yyyy", _permuted_late_day)))
    )


def _email(value: Column, key: str) -> Column:
    name = F.substr(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), F.lit(1), F.lit(16))
    return F.concat(F.lit("u"), name, F.lit("@"), F.substring_index(value, "@", -1))


def _kind(value: Column) -> Column:
    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (
        F.when(value.contains("@"), "email")
        .when(whole(IPV4), "ipv4")
        .when(whole(SSN), "ssn")
        .when(whole("|".join((ISO_DATE, DAY_DATE, MONTH_DATE))), "date")
        .when(whole(CARD), "card")
        .when(whole(PHONE), "phone")
        .otherwise("iban")
    )


_BY_KIND = {
    "email": _email, "ipv4": _ipv4, "ssn": _ssn, "date": _date, "card": _card, "phone": _phone, "iban": _iban,
}


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """What stands for a found value; NULL if it fails validation."""
    out = None
    for name, made in _BY_KIND.items():
        out = F.when(kind == name, made(value, key)) if out is None else out.when(kind == name, made(value, key))
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text", kinds: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text`` replaced. With ``kinds``, a column
    of that name lists what kinds of values were, in order."""

    def judged(value: Column) -> Column:
        return _with(_kind(value), lambda kind: F.struct(pseudonym(value, kind, key).alias("new"), kind.alias("kind")))

    own = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    source = F.col("row")[text]
    # One plain scan tells texts that can have no value.
    may = source.rlike("[0-9@]")
    found = own.withColumn("values", F.when(may, F.regexp_extract_all(source, F.lit(ANY), F.lit(0))))
    rows = found.withColumn("new", F.transform("values", judged))
    shown = F.zip_with("values", "new", lambda old, new: F.coalesce(new["new"], old))
    pieces = F.zip_with(
        F.split(source, ANY, -1),
        F.concat(shown, F.array(F.lit(""))),
        lambda gap, value: F.concat(gap, value),
    )
    replaced = F.when(F.size("values") > 0, F.array_join(pieces, "")).otherwise(source)
    out = rows.withColumn("replaced", replaced)
    columns = [(F.col("replaced") if c == text else F.col("row")[c]).alias(c) for c in docs.columns if c != kinds]
    if kinds:
        valid = F.filter(F.coalesce("new", F.array()), lambda x: x["new"].isNotNull())
        columns.append(F.transform(valid, lambda x: x["kind"]).alias(kinds))
    return out.select(*columns)
