"""Format-preserving pseudonyms: a keyed Feistel network over the digits, letters or day number of each validated value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
_IBANS = "|".join(f"(?:{c.replace(' ', '|')})\\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
_COUNTRIES = "|".join(c.replace(" ", "|") for c in IBAN_LENGTHS.values())
_HEX = "[0-9A-Fa-f]{1,4}"
#: Kinds in order of precedence, each with a pattern that matches a whole value.
KINDS = {
    "email": "[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip6": f"(?=[0-9A-Fa-f:]*\\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?=(?:[0-9A-Fa-f]*:){{2,7}}[0-9A-Fa-f]*(?![0-9A-Fa-f:]))(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:{_HEX}(?::{_HEX}){{0,5}})?)",
    "date": "\\d{4}-\\d{2}-\\d{2}|\\d{1,2}[/.]\\d{1,2}[/.]\\d{4}",
    "ip": "\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}",
    "ssn": "\\d{3}-\\d{2}-\\d{4}",
    "phone": "\\+\\d{8,15}|(?:1[ .-])?\\d{3}[.-]\\d{3}[.-]\\d{4}|(?:1 )?[2-9]\\d{2} [2-9]\\d{2} \\d{4}|[2-9]\\d{2}[2-9]\\d{6}|\\(\\d{3}\\) ?\\d{3}[ .-]\\d{4}|\\+\\d{1,3} ?\\(\\d{1,4}\\) ?\\d{2,4}(?:[ .-]\\d{2,4}){1,3}|\\+\\d{1,3}(?:[ .-]\\d{1,8}){1,6}",
    "card": "\\d{13,19}|\\d{4}(?:[ -]\\d{4}){3}(?:[ -]\\d{1,3})?|\\d{4}[ -]\\d{6}[ -]\\d{5}",
    # by the country's length; of any length for countries without one
    "iban": f"{_IBANS}|(?!{_COUNTRIES})[A-Z]{{2}}\\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?",
}
#: Country calling codes of one and two digits; the rest have three. Fixed values.
_CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: Digits behind the calling code at most, where a number is written in groups, so that the next number is no part of it.
NATIONAL = {
    8: "45 47 53 65", 9: "27 31 32 33 34 36 40 41 48 51 56 61 66 93 94", 10: "1 7 20 30 44 46 52 57 58 60 63 64 81 82 84 90 91 92 95 98", 11: "39 49 54 55 86", 12: "62", 13: "43",
}
#: Where a value may begin and end. A date may be followed by a time.
_BEGIN, _MAIL_BEGIN = "(?<![\\w+@])(?<![A-Za-z_]-)(?<!\\d\\.)", "(?<![\\w+@-])(?<!\\d\\.)"
_TIME = "T\\d{2}(?![0-9A-Z])"
_END = f"(?:(?<=\\d)(?={_TIME})|(?![\\w@])(?!-[A-Za-z])(?!\\.\\d)(?!:[0-9A-Fa-f]{{0,4}}:)(?![.%+-][A-Za-z0-9._%+-]{{0,63}}@))"
_IP6 = f"(?<![\\w:.@+-]){KINDS['ip6']}(?![\\w:@])(?!-[A-Za-z])(?!\\.\\w)"
#: What is looked at for values: mail addresses, addresses of the internet, and runs of digits, capitals and what may stand between
#: the groups of a number.
PATTERN = f"{_MAIL_BEGIN}{KINDS['email']}(?![\\w@-])(?!\\.\\d)|{_IP6}|{_BEGIN}(?:[+(]|(?=\\d|[A-Z]{{2}}\\d{{2}}))[0-9A-Z+(][0-9A-Z ()./+-]*[0-9A-Z]{_END}"
#: Pieces of a run: letters and digits (up to a time), or one other character. A value has so many of them at most.
_PIECE, PIECES = f"(?:(?!(?<=\\d){_TIME})[0-9A-Z])+|T\\d{{2}}|[^0-9A-Z]", 17
_NOT_AFTER, _NOT_BEFORE = "(?:[\\w+@]|[A-Za-z_]-|\\d\\.)$", f"^(?:(?!{_TIME})\\w|-[A-Za-z]|\\.\\d)"
#: Runs without this have no value: seven digits, a short date or an address, or the head of an IBAN.
_LIKELY = "(?:\\d[ ()./+-]{0,2}){7}|\\d[/.]\\d{1,2}[/.]\\d|[A-Z]{2}\\d{2} ?[A-Z0-9]{4}"
_FIRST_DAY, _DAYS = "1900-01-01", 73049  # through 2099-12-31; 17 * 4297, so a network over both factors permutes the days


def _number(key: str, round_: Column, *parts: Column) -> Column:
    """52 pseudo-random bits of key, round and value."""
    text = F.concat_ws(":", F.lit(key), round_.cast("string"), *parts)
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def permuted_number(value: Column, first: Column, second: Column, key: str, tag: Column) -> Column:
    """A permutation of [0, first * second): an alternating Feistel network over value div second and value mod second."""
    start = F.struct(F.call_function("div", value, second).alias("l"), F.pmod(value, second).cast("long").alias("r"))

    def step(state: Column, i: Column) -> Column:
        l, r = state.getField("l"), state.getField("r")
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(
            F.when(even, F.pmod(l + _number(key, i, tag, r.cast("string")), first)).otherwise(l).alias("l"),
            F.when(even, r).otherwise(F.pmod(r + _number(key, i, tag, l.cast("string")), second)).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s.getField("l") * second + s.getField("r"))


def _power(n: Column) -> Column:
    return F.element_at(F.array(*(F.lit(10**i).cast("long") for i in range(19))), n + 1)


def permuted_digits(digits: Column, key: str, tag: Column) -> Column:
    """A digit string of up to 18 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    out = permuted_number(digits.cast("long"), _power(n - half), _power(half), key, tag)
    return F.lpad(out.cast("string"), n, "0")


def _shift(text: Column, other: Column, key: str, round_: Column) -> Column:
    """Each letter and digit of text moved within its class by amounts that depend on other; the rest stays."""
    bytes_ = F.sha2(F.concat_ws(":", F.lit(key), round_.cast("string"), F.length(text).cast("string"), other), 256)

    def moved(i: Column) -> Column:
        c = F.substring(text, i + 1, F.lit(1))
        by = F.conv(F.substring(bytes_, F.pmod(i * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        inside = lambda low, size: F.char(F.pmod(code - low + by, F.lit(size)) + low)
        return F.when(code.between(48, 57), inside(48, 10)).when(code.between(97, 122), inside(97, 26)).when(code.between(65, 90), inside(65, 26)).otherwise(c)

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.length(text) - 1), moved), ""))


def permuted_text(text: Column, key: str) -> Column:
    """A string permuted among those with the same classes of characters: a Feistel network over its two halves."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.length(text)).alias("r"))

    def step(state: Column, i: Column) -> Column:
        l, r = state.getField("l"), state.getField("r")
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(F.when(even, _shift(l, r, key, i)).otherwise(l).alias("l"), F.when(even, r).otherwise(_shift(r, l, key, i)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s.getField("l"), s.getField("r")))


def permuted_hex(digits: Column, key: str) -> Column:
    """A string of lower-case hexadecimal digits permuted among those of its length: a Feistel network over its two halves."""
    alphabet = "0123456789abcdef"
    half = F.floor(F.length(digits) / 2).cast("int")
    start = F.struct(F.substring(digits, F.lit(1), half).alias("l"), F.substring(digits, half + 1, F.length(digits)).alias("r"))

    def shift(own: Column, other: Column, i: Column) -> Column:
        hash_ = F.sha2(F.concat_ws(":", F.lit(key), F.lit("hex"), i.cast("string"), F.length(own).cast("string"), other), 256)
        place = lambda text, at: F.instr(F.lit(alphabet), F.substring(text, at, F.lit(1))) - 1
        moved = lambda at: F.substring(F.lit(alphabet), F.pmod(place(own, at) + place(hash_, at), F.lit(16)) + 1, F.lit(1))
        return F.when(F.length(own) == 0, own).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(own)), moved), ""))

    def step(state: Column, i: Column) -> Column:
        l, r = state.getField("l"), state.getField("r")
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(F.when(even, shift(l, r, i)).otherwise(l).alias("l"), F.when(even, r).otherwise(shift(r, l, i)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s.getField("l"), s.getField("r")))


def _fill_hex(shape: Column, digits: Column) -> Column:
    """The digits between the colons of shape replaced in order, in capitals if shape has some."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(state: Column, c: Column) -> Column:
        colon = c == ":"
        return F.struct(F.concat(state.getField("out"), F.when(colon, c).otherwise(F.substring(digits, state.getField("at"), F.lit(1)))).alias("out"), (state.getField("at") + (~colon).cast("int")).alias("at"))

    out = F.aggregate(F.split(shape, "(?!^)"), start, step, lambda s: s.getField("out"))
    return F.when(shape.rlike("[A-F]"), F.upper(out)).otherwise(out)


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn rule over a digit string; a multiple of 10 if the last digit checks."""
    back = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), lambda i: F.struct(F.pmod(i, F.lit(2)).alias("odd"), F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int").alias("d")))
    return F.aggregate(back, F.lit(0), lambda a, x: a + F.when(x.odd == 0, x.d).when(x.d > 4, x.d * 2 - 9).otherwise(x.d * 2))


def _iban_rest(value: Column) -> Column:
    compact = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    codes = F.transform(F.array_remove(F.split(turned, "(?!^)"), ""), lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(codes, F.lit(0), lambda a, x: F.pmod(a * F.when(x > 9, 100).otherwise(10) + x, F.lit(97)))


def _fill(shape: Column, digits: Column) -> Column:
    """The digits of shape replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(state: Column, c: Column) -> Column:
        is_digit = F.ascii(c).between(48, 57)
        return F.struct(F.concat(state.getField("out"), F.when(is_digit, F.substring(digits, state.getField("at"), F.lit(1))).otherwise(c)).alias("out"), (state.getField("at") + is_digit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, "(?!^)"), start, step, lambda s: s.getField("out"))


def _padded(value: Column) -> Column:
    """A date with two digits for days and months."""
    return F.regexp_replace(value, "(?<!\\d)(\\d)(?=[/.])", "0$1")


def _date(value: Column) -> Column:
    """The day of a date string, null if there is none such: ISO, day.month.year, and month/day/year or else day/month/year."""
    return F.coalesce(*(F.try_to_timestamp(_padded(value), F.lit(f)) for f in ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "dd.MM.yyyy"))).cast("date")


_LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)


def _day_first(value: Column, key: str, tag: Column) -> Column:
    """dd/MM/yyyy with a day over 12, permuted among those, so that it can't be read as month/day.

    Days to 28 are permuted with month and year; later ones keep the day and are permuted over the months (and, for the
    29th of February, the leap years) that have it.
    """
    day, month, year = (F.substring(value, a, n).cast("long") for a, n in ((1, 2), (4, 2), (7, 4)))
    months = F.array(*(F.lit(m) for m in _LONG_MONTHS))
    cases = (  # condition, number, its two factors, and day, month, year of a number
        (day <= 28, ((year - 1900) * 12 + month - 1) * 16 + day - 13, 2400, 16, lambda n: (F.pmod(n, F.lit(16)) + 13, F.pmod(F.call_function("div", n, F.lit(16)), F.lit(12)) + 1, F.call_function("div", n, F.lit(192)) + 1900)),
        (month == 2, F.call_function("div", year - 1904, F.lit(4)), 7, 7, lambda n: (day, month, n * 4 + 1904)),
        (day == 31, (year - 1900) * 7 + F.array_position(months, month.cast("int")) - 1, 200, 7, lambda n: (day, F.get(months, F.pmod(n, F.lit(7)).cast("int")), F.call_function("div", n, F.lit(7)) + 1900)),
        (F.lit(True), (year - 1900) * 11 + F.when(month > 1, month - 2).otherwise(0), 200, 11, lambda n: (day, F.when(F.pmod(n, F.lit(11)) > 0, F.pmod(n, F.lit(11)) + 2).otherwise(1), F.call_function("div", n, F.lit(11)) + 1900)),
    )
    pick = lambda at: F.coalesce(*(F.when(c[0], c[at] if isinstance(c[at], Column) else F.lit(c[at])).cast("long") for c in cases))
    moved = permuted_number(pick(1), pick(2), pick(3), key, F.concat_ws(":", tag, F.when(day > 28, day.cast("string")).otherwise("")))
    text = lambda parts: F.concat_ws("/", *(F.lpad(x.cast("string"), n, "0") for x, n in zip(parts, (2, 2, 4), strict=True)))
    # the array of one element binds the number, so that it is worked out once
    return F.transform(F.array(moved), lambda n: F.coalesce(*(F.when(c[0], text(c[4](n))) for c in cases)))[0]


def _ssn(digits: Column, key: str, tag: Column) -> Column:
    """A social security number permuted among the valid ones: areas 1 to 899 but 666, groups from 1, serials from 1."""
    area, group, serial = (F.substring(digits, a, n).cast("long") for a, n in ((1, 3), (4, 2), (6, 4)))
    number = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    moved = permuted_number(number, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, tag)

    def text(n: Column) -> Column:
        rest = F.call_function("div", n, F.lit(9999))
        area = F.call_function("div", rest, F.lit(99)) + 1
        parts = (area + (area >= 666).cast("int"), 3), (F.pmod(rest, F.lit(99)) + 1, 2), (F.pmod(n, F.lit(9999)) + 1, 4)
        return F.concat(*(F.lpad(x.cast("string"), size, "0") for x, size in parts))

    return F.transform(F.array(moved), text)[0]


def _calling(value: Column) -> Column:
    """The calling code of a number that begins with +, else an empty string."""
    return F.regexp_extract(value, f"^\\+({_CALLING}|\\d{{1,3}})", 1)


def _national(code: Column) -> Column:
    """Digits behind a calling code at most, in grouped numbers."""
    most = F.create_map(*(F.lit(x) for n, codes in NATIONAL.items() for c in codes.split() for x in (c, n)))
    return F.coalesce(F.try_element_at(most, code), F.lit(12))


def kind_of(value: Column) -> Column:
    """The kind of a candidate if it is valid, else null."""
    digits = F.regexp_replace(value, "\\D", "")
    whole = lambda k: value.rlike(f"^(?:{KINDS[k]})$")
    octets = F.forall(F.split(value, "\\."), lambda x: x.cast("int") <= 255)
    area = F.substring(digits, 1, 3)
    return (
        F.when(whole("email"), F.lit("email"))
        .when(whole("ip6"), F.lit("ip6"))
        .when(whole("date"), F.when(F.datediff(_date(value), F.lit(_FIRST_DAY).cast("date")).between(0, _DAYS - 1), F.lit("date")))
        .when(whole("ip"), F.when(octets, F.lit("ip")))
        .when(whole("ssn"), F.when(~area.isin("000", "666") & (area < "900") & (F.substring(digits, 4, 2) != "00") & (F.substring(digits, 6, 4) != "0000"), F.lit("ssn")))
        .when(whole("phone") & F.length(digits).between(8, 15) & (~value.rlike("^\\+.*\\D") | (F.length(digits) - F.length(_calling(value)) <= _national(_calling(value)))), F.lit("phone"))
        .when(whole("card"), F.when(luhn_sum(digits) % 10 == 0, F.lit("card")))
        .when(whole("iban"), F.when(_iban_rest(value) == 1, F.lit("iban")))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value of the same kind and format that stands for a valid one; equal values get equal ones."""
    digits = F.regexp_replace(value, "\\D", "")
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, kind)
    check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    day = permuted_number(F.datediff(_date(value), F.lit(_FIRST_DAY).cast("date")).cast("long"), F.lit(17).cast("long"), F.lit(_DAYS // 17).cast("long"), key, kind)
    date = F.date_add(F.lit(_FIRST_DAY).cast("date"), day.cast("int"))
    shaped = F.when(value.contains("-"), F.date_format(date, "yyyy-MM-dd")).when(value.contains("."), F.date_format(date, "dd.MM.yyyy"))
    shaped = shaped.when(F.substring(_padded(value), 1, 2) > "12", _day_first(_padded(value), key, kind)).otherwise(F.date_format(date, "MM/dd/yyyy"))
    shaped = F.when(_padded(value) != value, F.regexp_replace(shaped, "(?<!\\d)0(\\d)(?=[/.])", "$1")).otherwise(shaped)
    parts = F.transform(F.split(value, "\\."), lambda x: x.cast("long"))
    address = permuted_number(F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x), F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, kind)
    quad = F.concat_ws(".", *(F.pmod(F.floor(address / (1 << s)), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))
    at = F.instr(value, "@")
    country = _calling(value)
    local = F.substring(digits, F.length(country) + 1, F.length(digits))
    phone = _fill(value, F.concat(country, permuted_digits(local, key, kind)))
    iban = permuted_text(F.substring(F.replace(value, F.lit(" "), F.lit("")), F.lit(5), F.length(value)), key)
    return (
        F.when(kind == "email", F.concat(permuted_text(F.substring(value, F.lit(1), at - 1), key), F.lit("@"), permuted_text(F.regexp_extract(value, "@(.*)\\.", 1), key), F.regexp_extract(value, "(\\.[^.]*)$", 1)))
        .when(kind == "ip6", _fill_hex(value, permuted_hex(F.lower(F.replace(value, F.lit(":"), F.lit(""))), key)))
        .when(kind == "date", shaped)
        .when(kind == "ip", quad)
        .when(kind == "card", _fill(value, F.concat(body, check)))
        .when(kind == "ssn", _fill(value, _ssn(digits, key, kind)))
        .when(kind == "phone", phone)
        .when(kind == "iban", _iban(value, iban))
        .otherwise(value)
    )


def _iban(value: Column, account: Column) -> Column:
    """Country, new check digits and account, with the blanks of value."""
    country = F.substring(value, 1, 2)
    check = F.lpad((F.lit(98) - _iban_rest(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    compact = F.concat(country, check, account)
    grouped = F.trim(F.regexp_replace(compact, "(.{4})", "$1 "))
    return F.when(value.contains(" "), grouped).otherwise(compact)


def _let(value: Column, f) -> Column:
    """f(value), with value worked out once."""
    return F.transform(F.array(value), f)[0]


def _longest(pieces: Column, at: Column) -> Column:
    """n (pieces) and kind of the longest valid value that begins at a piece, null if there is none."""
    text = lambda start, n: F.array_join(F.slice(pieces, start, n), "")
    before = text(F.greatest(at - 2, F.lit(1)), F.least(at - 1, F.lit(2)))
    begins = F.get(pieces, at - 1).rlike("^(?:[+(]|\\d|[A-Z]{2}\\d{2})") & ~before.rlike(_NOT_AFTER)

    def tried(n: Column) -> Column:
        ends = F.get(pieces, at + n - 2).rlike("^[0-9A-Z]") & ~text(at + n, F.lit(2)).rlike(_NOT_BEFORE)
        return F.struct(n.alias("n"), F.when(ends, kind_of(text(at, n))).alias("kind"))

    lengths = F.sequence(F.least(F.lit(PIECES), F.size(pieces) - at + 1), F.lit(1), F.lit(-1))
    return F.when(begins, F.get(F.filter(F.transform(lengths, tried), lambda x: x.kind.isNotNull()), 0))


_PICKS = "array<struct<at:int,n:int,kind:string>>"


def _picked(found: Column) -> Column:
    """Of the values found at each piece those that are taken, from left to right, with no overlap."""
    start = F.struct(F.lit(1).alias("next"), F.array().cast(_PICKS).alias("picks"))

    def step(state: Column, i: Column) -> Column:
        own = F.get(found, i - 1)
        pick = F.struct(i.alias("at"), own.n.alias("n"), own.kind.alias("kind"))
        taken = F.struct((i + own.n).alias("next"), F.array_append(state.picks, pick).cast(_PICKS).alias("picks"))
        return F.when(own.isNotNull() & (i >= state.next), taken).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda s: s.picks)


def values_in(run: Column) -> Column:
    """A match of PATTERN as its parts in order: (value, kind), of null kind what stays. Joined, they are the match.

    A run that is no value as a whole is read from left to right; at each piece the longest valid value is taken, and
    reading goes on behind it.
    """
    part = lambda value, kind: F.struct(value.alias("value"), kind.alias("kind"))
    none = F.lit(None).cast("string")

    def parts(pieces: Column) -> Column:
        text = lambda start, n: F.array_join(F.slice(pieces, start, n), "")

        def cut(picks: Column) -> Column:
            end = lambda j: F.when(j < 0, 1).otherwise(F.get(picks, F.greatest(j, F.lit(0))).at + F.get(picks, F.greatest(j, F.lit(0))).n)
            each = F.transform(picks, lambda x, j: F.array(part(text(end(j - 1), x.at - end(j - 1)), none), part(text(x.at, x.n), x.kind)))
            last = end(F.size(picks) - 1)
            return F.concat(F.flatten(each), F.array(part(text(last, F.size(pieces) - last + 1), none)))

        found = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda at: _longest(pieces, at))
        return _let(found, lambda values: _let(_picked(values), cut))

    kind = F.when(run.rlike(_LIKELY) | run.rlike("[@:]"), kind_of(run))
    split = kind.isNull() & run.rlike(_LIKELY) & ~run.contains("@")
    return F.when(split, _let(F.regexp_extract_all(run, F.lit(_PIECE), F.lit(0)), parts)).otherwise(F.array(part(run, kind)))


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """docs (doc_id, text and any more columns) with its text changed, and pii_kinds, pii_values: the finds in order.

    Values that are valid of their kind (Luhn for cards, mod 97 for IBANs, calendar dates from 1900 to 2099, octets to 255,
    addresses of version 6 with a digit in them, assigned social security numbers, telephone numbers of 8 to 15 digits, mail
    addresses) are replaced by a keyed permutation of the values of that format: digits stay digits, cards and IBANs keep
    valid check digits, dates stay dates. So equal values stay equal in all documents, and different ones different.
    pii_values holds the pseudonyms, never the originals. One map over the table, without a shuffle.

    key is secret: with it all pseudonyms can be turned back. Dates are ISO (a time may follow), d.M.yyyy, M/d/yyyy, and
    d/M/yyyy where the day is over 12. Telephone numbers are international ones, and North American ones in the usual
    groups or as ten digits that may be one. Of mail addresses the last part of the domain stays.

    Null and empty texts: as they are, no finds. Texts are read whole, whatever their length. Repeated rows and null
    doc_ids: changed alike. Where several values are possible, the leftmost is taken, of these the longest, and of equal
    ones the first in the order of KINDS. Other columns pass through, but for pii_kinds and pii_values, which are
    replaced. An empty table gives an empty result.
    """
    docs = docs.drop("pii_kinds", "pii_values")
    text = F.col("text")
    likely = text.rlike("\\d|@")
    found = F.when(likely, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    base = docs.select(F.struct("*").alias("row"), "text", F.transform(found, values_in).alias("found"))
    base = base.select("row", "text", F.transform("found", lambda parts: F.transform(parts, lambda f: F.struct(f.kind.alias("kind"), pseudonym(f.value, f.kind, key).alias("value")))).alias("found"))
    gaps = F.split("text", PATTERN, -1)
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.array_join(F.transform(F.get(F.col("found"), i), lambda f: f.value), ""), F.lit("")))), "")
    changed = F.when(F.size("found") > 0, joined).otherwise(F.col("text"))
    real = F.filter(F.flatten("found"), lambda f: f.kind.isNotNull())
    columns = [(changed if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return base.select(*columns, F.coalesce(F.transform(real, lambda f: f.getField("kind")), F.array().cast("array<string>")).alias("pii_kinds"), F.coalesce(F.transform(real, lambda f: f.getField("value")), F.array().cast("array<string>")).alias("pii_values"))
