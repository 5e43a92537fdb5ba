"""Pseudonyms against a plain implementation of scanner, checks and Feistel networks, and injectivity of every format."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import pii

KEY = "k"
FIRST = datetime.date(1900, 1, 1)


def _sha(*parts):
    return hashlib.sha256(":".join(parts).encode()).hexdigest()


def _number(value, first, second, tag):
    left, right = divmod(value, second)
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            left = (left + int(_sha(KEY, str(i), tag, str(right))[:13], 16)) % first
        else:
            right = (right + int(_sha(KEY, str(i), tag, str(left))[:13], 16)) % second
    return left * second + right


def _digits(digits, tag):
    half = len(digits) // 2
    return str(_number(int(digits), 10 ** (len(digits) - half), 10**half, tag)).zfill(len(digits)) if digits else ""


def _text(text):
    half = len(text) // 2
    left, right = text[:half], text[half:]

    def moved(own, other, i):
        h = _sha(KEY, str(i), str(len(own)), other)
        out = []
        for j, c in enumerate(own):
            by = int(h[2 * j % 62 : 2 * j % 62 + 2], 16)
            for low, size in ((48, 10), (97, 26), (65, 26)):
                if low <= ord(c) < low + size:
                    c = chr((ord(c) - low + by) % size + low)
                    break
            out.append(c)
        return "".join(out)

    for i in range(pii.ROUNDS):
        left, right = (moved(left, right, i), right) if i % 2 == 0 else (left, moved(right, left, i))
    return left + right


CALLING = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _hex(text):
    half = len(text) // 2
    left, right = text[:half], text[half:]

    def moved(own, other, i):
        h = _sha(KEY, "hex", str(i), str(len(own)), other)
        return "".join(f"{(int(c, 16) + int(h[j], 16)) % 16:x}" for j, c in enumerate(own))

    for i in range(pii.ROUNDS):
        left, right = (moved(left, right, i), right) if i % 2 == 0 else (left, moved(right, left, i))
    return left + right


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(digits)))


def _mod97(compact):
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def _padded(value):
    return re.sub(r"\b(\d)(?=[/.])", r"0\1", value)


def _day(value):
    value = _padded(value)
    for form in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d.%m.%Y"):
        try:
            return datetime.datetime.strptime(value, form).date()
        except ValueError:
            pass
    return None


def _fill(shape, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def _date(value):
    padded = _padded(value)
    if padded != value:
        return re.sub(r"\b0(\d)(?=[/.])", r"\1", _date(padded))
    day = _day(value)
    if "/" in value and int(value[:2]) > 12:
        d, m, y = day.day, day.month, day.year
        if d <= 28:
            n = _number(((y - 1900) * 12 + m - 1) * 16 + d - 13, 2400, 16, "date:")
            return f"{n % 16 + 13:02}/{n // 16 % 12 + 1:02}/{n // 192 + 1900}"
        if m == 2:
            return f"29/02/{_number((y - 1904) // 4, 7, 7, f'date:{d}') * 4 + 1904}"
        months = [1, 3, 5, 7, 8, 10, 12] if d == 31 else [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
        n = _number((y - 1900) * len(months) + months.index(m), 200, len(months), f"date:{d}")
        return f"{d}/{months[n % len(months)]:02}/{n // len(months) + 1900}"
    new = FIRST + datetime.timedelta(_number((day - FIRST).days, 17, 4297, "date"))
    return new.strftime("%Y-%m-%d" if "-" in value else "%m/%d/%Y" if "/" in value else "%d.%m.%Y")


def _pseudonym(value):
    """(kind, pseudonym), None for a candidate that is not valid."""
    whole = lambda k: re.fullmatch(pii.KINDS[k], value, re.A)
    digits = re.sub(r"\D", "", value)
    if whole("email"):
        local, domain = value.split("@", 1)
        return "email", f"{_text(local)}@{_text(domain.rpartition('.')[0])}.{domain.rpartition('.')[2]}"
    if whole("ip6"):
        moved = iter(_hex(value.replace(":", "").lower()))
        new = "".join(c if c == ":" else next(moved) for c in value)
        return "ip6", new.upper() if re.search("[A-F]", value) else new
    if whole("date"):
        day = _day(value)
        return ("date", _date(value)) if day and 0 <= (day - FIRST).days < 73049 else None
    if whole("ip"):
        parts = list(map(int, value.split(".")))
        if max(parts) > 255:
            return None
        n = _number(int.from_bytes(bytes(parts)), 65536, 65536, "ip")
        return "ip", ".".join(str(b) for b in n.to_bytes(4))
    if whole("ssn"):
        a, g, s = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if a in (0, 666) or a >= 900 or not g or not s:
            return None
        n = _number(((a - (2 if a > 666 else 1)) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999, "ssn")
        area = n // 9999 // 99 + 1
        return "ssn", _fill(value, f"{area + (area >= 666):03}{n // 9999 % 99 + 1:02}{n % 9999 + 1:04}")
    if whole("phone"):
        if not 8 <= len(digits) <= 15:
            return None
        country = ""
        if value[0] == "+":  # calling codes are free of prefixes
            lead = re.match(r"\+(\d{1,3})", value)[1]
            country = next((lead[:n] for n in (1, 2) if lead[:n] in CALLING), lead)
            if re.search(r"\D", value[1:]) and len(digits) - len(country) > next((n for n, codes in pii.NATIONAL.items() if country in codes.split()), 12):
                return None
        return "phone", _fill(value, country + _digits(digits[len(country) :], "phone"))
    if whole("card") and not _luhn(digits) % 10:
        body = _digits(digits[:-1], "card")
        return "card", _fill(value, body + str(-_luhn(body + "0") % 10))
    compact = value.replace(" ", "")
    if not whole("iban") or _mod97(compact) != 1:
        return None
    account = _text(compact[4:])
    new = compact[:2] + str(98 - _mod97(compact[:2] + "00" + account)).zfill(2) + account
    return "iban", re.sub("(.{4})", r"\1 ", new).strip() if " " in value else new


MAIL = re.compile(r"(?<![\w+@-])(?<!\d\.)" + pii.KINDS["email"] + r"(?![\w@-])(?!\.\d)", re.A)
IP6 = re.compile(r"(?<![\w:.@+-])" + pii.KINDS["ip6"] + r"(?![\w:@]|-[A-Za-z]|\.\w)", re.A)
BEGIN = re.compile(r"(?<![\w+@])(?<![A-Za-z_]-)(?<!\d\.)[+(0-9A-Z]", re.A)
END = re.compile(r"(?<=[0-9A-Z])(?:(?<=\d)(?=T\d\d(?![0-9A-Z]))|(?![\w@]|-[A-Za-z]|\.\d|:[0-9A-Fa-f]{0,4}:|[.%+-][A-Za-z0-9._%+-]{0,63}@))", re.A)


def _plain(text):
    """Every place and every length, the longest first, without the scanner's pattern."""
    text, kinds, values, out, at = text or "", [], [], [], 0
    while at < len(text):
        m = MAIL.match(text, at) or IP6.match(text, at)
        ends = [m.end()] if m else [e for e in range(min(len(text), at + 50), at + 5, -1) if END.match(text, e)] if BEGIN.match(text, at) else []
        for end in ends:
            found = _pseudonym(text[at:end])
            if found and (m or found[0] not in ("email", "ip6")):
                kinds.append(found[0])
                values.append(found[1])
                out.append(found[1])
                at = end
                break
        else:
            out.append(text[at])
            at += 1
    return "".join(out), kinds, values


def _card(rng, n):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return body + str(-_luhn(body + "0") % 10)


def _values(rng):
    day = lambda: FIRST + datetime.timedelta(rng.randrange(-40, 73100))
    iban = lambda cc, n: (lambda a: f"{cc}{98 - _mod97(cc + '00' + a):02}{a}")("".join(rng.choice("0123456789") for _ in range(n)))
    kinds = [
        lambda: _card(rng, rng.randrange(13, 20)), lambda: "-".join(re.findall("....", _card(rng, 16))), lambda: str(rng.randrange(10**12, 10**18)), lambda: f"{day():%Y-%m-%d}", lambda: f"{day():%d/%m/%Y}", lambda: f"{day():%m/%d/%Y}", lambda: f"{day():%d.%m.%Y}",
        lambda: f"{day():%Y-%m-%d}T10:00:00", lambda: ".".join(str(rng.randrange(270)) for _ in range(4)), lambda: f"{rng.randrange(1000):03}-{rng.randrange(100):02}-{rng.randrange(10000):04}", lambda: f"+{rng.randrange(1, 999)} ({rng.randrange(10, 9999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}",
        lambda: f"{rng.randrange(100, 999)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}", lambda: "+" + str(rng.randrange(10**7, 10**15)), lambda: iban("DE", 18), lambda: " ".join(re.findall(".{1,4}", iban("AT", 16))), lambda: iban("MT", 27), lambda: iban("QQ", 16), lambda: f"{rng.choice('abcXY')}{rng.randrange(99)}.{rng.choice('uvw')}@mail{rng.randrange(9)}.example.com", lambda: "plain", lambda: "31/02/2020",
        lambda: f"+{rng.choice(['1', '44', '49', '358', '33'])}" + "".join(rng.choice(" -.") + str(rng.randrange(10 ** rng.randrange(1, 5))) for _ in range(rng.randrange(2, 6))), lambda: " ".join(re.findall("....", _card(rng, 16))), lambda: str(rng.randrange(2 * 10**9, 10**10)),
        lambda: f"{rng.randrange(100, 999)}.{rng.randrange(100, 999)}.{rng.randrange(1000, 9999)}", lambda: f"{(d := day()).month}/{d.day}/{d.year}", lambda: f"{(d := day()).day}.{d.month}.{d.year}", lambda: f"{_card(rng, 16)}-{rng.randrange(9)}", lambda: str(rng.randrange(3000)), lambda: f"{rng.randrange(24)}:{rng.randrange(60)}:10",
        lambda: ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(8)), lambda: f"{rng.randrange(1 << 16):X}::{rng.randrange(1 << 12):X}", lambda: "FOO.BAR@X.COM", lambda: "(212) 555-0" + str(rng.randrange(100, 999)), lambda: rng.choice(["abc-", "x", "T", "NO", "("]) + str(rng.randrange(10**6)),
    ]
    return rng.choice(kinds)()


def test_texts_are_changed_like_plainly(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(_values(rng) + rng.choice(["", "", "", ",", ".", " now", " OK", " 500 EUR", "-", "/"]) for _ in range(12))) for i in range(700)] + [(1000, None), (1001, ""), (None, "1.2.3.4"), (1002, "AT61 1904 3002 3457 3201 OK now"), (1003, "x 31/12/1999 y 555-123-4567 z")]
    texts += [(-1 - r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = pii.pseudonymize(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), KEY).collect()
    want = {i: _plain(t) for i, t in texts}
    assert sum(len(k) for _, k, _ in want.values()) > 4500
    for r in got:
        text, kinds, values = want[r["doc_id"]]
        assert ((r["text"] or ""), r["pii_kinds"], r["pii_values"]) == (text, kinds, values), r["doc_id"]


def test_nothing_swallows_its_neighbour(spark):
    cases = {
        "call +1 202 555 0123 4111 1111 1111 1111 now": ["phone", "card"], "+44 20 7946 0958 12 34 56": ["phone"], "1234 4111 1111 1111 1111": ["card"], "5 2024-01-02T10:00:00": ["date"], "1234 FOO.BAR@x.com": ["email"],
        "DE89 3704 0044 0532 0130 00 4111111111111111": ["iban", "card"], "2025550123 202.555.0123 1/2/1980 2001:db8::1 4111111111111111-2 a@b.co": ["phone", "phone", "date", "ip6", "card", "email"], "10.0.0.1:8080 10:20:30 std::dec": ["ip"],
    }
    got = pii.pseudonymize(spark.createDataFrame([(k,) for k in cases], "text string").withColumn("was", F.col("text")), KEY).collect()
    for r in got:
        assert r["pii_kinds"] == cases[r["was"]] and not any(v in r["text"] for v in ("555", "4111", "7946", "FOO", "1980", "db8", "10.0", "3704", "a@b", "2024-01-02")), r
    one = pii.pseudonymize(spark.createDataFrame([("+1 202 555 0123 +12025550123 202-555-0123",)], "text string"), KEY).first()["pii_values"]
    assert len({v[-12:].replace(" ", "").replace("-", "")[-10:] for v in one}) == 1
    long = "12 345 " * 20_000 + "4111 1111 1111 1111"
    assert pii.pseudonymize(spark.createDataFrame([(long,)], "text string"), KEY).first()["pii_kinds"][-1:] == ["card"]


@pytest.mark.parametrize("make", [
    lambda rng: [_card(rng, n) for n in range(13, 20) for _ in range(400)] + ["0009999999999999994", "9999999999999999990"],
    lambda rng: [f"{d:02}/{m:02}/{y}" for y in range(1900, 2100) for m in range(1, 13) for d in range(13, 32) if d > 27 and m < 5 and _day(f"{d:02}/{m:02}/{y}")],
    lambda rng: [f"{rng.randrange(1, 900):03}-{rng.randrange(1, 100):02}-{rng.randrange(1, 10000):04}" for _ in range(3000)],
    lambda rng: [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(3000)],
])
def test_different_values_stay_different_and_valid(spark, make):
    values = sorted({v for v in make(random.Random(6)) if _pseudonym(v)})
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    marked = df.select("v", pii.kind_of(F.col("v")).alias("kind"))
    got = [r["p"] for r in marked.select(pii.pseudonym(F.col("v"), F.col("kind"), KEY).alias("p")).collect()]
    assert len(set(got)) == len(values) > 2000 and all(_pseudonym(p) for p in got)
