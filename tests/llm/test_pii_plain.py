"""Pseudonyms against a plain Python version of finding, permuting and check
digits, and texts of a million characters of any kind of repetition."""

import calendar
import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from mercato.llm import pii

KEY = "k-test"


def stream(kind, r, other):
    return hashlib.sha512(f"{KEY}|{kind}|{r}|{other}".encode()).hexdigest()


def moved(half, kind, r, other, hexa):
    s, out = stream(kind, r, other), ""
    for i, c in enumerate(half):
        by = int(s[2 * (i % 64):2 * (i % 64) + 2], 16)
        for first, size in (("0", 10), ("a", 6 if hexa else 26), ("A", 26)):
            if first <= c <= {"0": "9", "a": "z", "A": "Z"}[first]:
                c = chr((ord(c) - ord(first) + by) % size + ord(first))
                break
        out += c
    return out


def permute(s, kind, hexa=False):
    if len(s) < 2:
        return moved(s, kind, 0, "", hexa)
    for r in range(pii.ROUNDS):
        h = len(s) // 2
        a, b = s[:h], s[h:]
        s = moved(a, kind, r, b, hexa) + b if r % 2 == 0 else a + moved(b, kind, r, a, hexa)
    return s


def permute_number(x, radix, kind):
    a, b = divmod(x, radix[1])
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + int(stream(kind, r, b)[:14], 16)) % radix[0]
        else:
            b = (b + int(stream(kind, r, a)[:14], 16)) % radix[1]
    return a * radix[1] + b


def refill(m, new, of="0-9"):
    it = iter(new)
    return re.sub(f"[{of}]", lambda _: next(it), m)


def luhn_sum(digits, weight):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if (i + weight) % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return total


def card(m):
    d = re.sub("[^0-9]", "", m)
    body = d[0] + permute(d[1:-1], "card")
    return refill(m, body + str(-luhn_sum(body, 0) % 10))


def valid_card(c):
    return luhn_sum(re.sub("[^0-9]", "", c), 1) % 10 == 0


def cards(m, odd):
    """From the left, the first written form that is valid at each group."""
    out, at, n = "", 0, 0
    while at < len(m):
        begins = at == 0 or not m[at - 1].isdigit()
        found = None
        if begins and m[at].isdigit():
            near = "".join(re.findall("[0-9]+[ -]?|[^0-9]+", m[at:])[:5])
            for form in (pii.CARD, pii.CARD_19):
                x = re.match(form, near)
                if x and valid_card(x.group()):
                    found = x.group()
                    break
        if found:
            out, n = out + card(found), n + 1
            at += len(found)
        else:
            out += m[at]
            at += 1
    digits = re.sub("[^0-9]", "", m)
    if not n and odd and 13 <= len(digits) <= 19 and luhn_sum(digits, 1) % 10 == 0:
        return card(m), 1
    return out, n


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s)) % 97


def other_day(day):
    first = dt.date(1900, 1, 1)
    return first + dt.timedelta(days=permute_number((day - first).days, pii.DAYS, "date"))


def day_of(y, m, d):
    if 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]:
        return dt.date(y, m, d)
    return None


def pseudonym(m):
    full = lambda p: re.fullmatch(p, m)
    if full(pii.EMAIL):
        head, tail = re.fullmatch(r"(.*)(\.[A-Za-z]+)", m).groups()
        new = permute(head.lower(), "email")
        return "".join(b.upper() if a.isupper() else b for a, b in zip(head, new)) + tail, None
    if re.match("(?i:password|passwd|pwd|secret|token|api)", m):
        name, value = re.fullmatch("(.*[=:][ \t]{0,4}[\"']?)([A-Za-z0-9+/_-]+)", m).groups()
        return name + permute(value, "secret", bool(re.fullmatch("[0-9a-f]+", value))), None
    if full(pii.ACCESS_KEY):
        return m[:4] + permute(m[4:], "access"), None
    if re.match("[A-Z]{2}", m):
        s = m.replace(" ", "")
        if mod97(s[4:] + s[:4]) != 1:
            return cards(m, False)
        new = permute(s[4:], "iban")
        return refill(m, s[:2] + str(98 - mod97(new + s[:2] + "00")).zfill(2) + new, "0-9A-Z"), None
    if full(pii.IP):
        a, b, c, d = map(int, m.split("."))
        y = permute_number(((a * 256 + b) * 256 + c) * 256 + d, pii.ADDRESSES, "ip")
        return ".".join(str(y >> k & 255) for k in (24, 16, 8, 0)), None
    if full(pii.DATE_YMD):
        y, mo, d = re.split("[/-]", m)
        day = day_of(int(y), int(mo), int(d))
        if not day:
            return m, None
        new, sep = other_day(day), m[4]
        return (f"{new.year}{sep}{new.month:02}{sep}{new.day:02}" if len(mo) == len(d) == 2
                else f"{new.year}{sep}{new.month}{sep}{new.day}"), None
    if full(pii.DATE_DMY):
        a, b, y = re.split("[/.-]", m)
        sep = re.search("[/.-]", m).group()
        day_first = int(b) <= 12 if sep != "/" else int(a) > 12
        d, mo = (a, b) if day_first else (b, a)
        day = day_of(int(y), int(mo), int(d))
        if not day:
            return m, None
        new, wide = other_day(day), len(a) == len(b) == 2
        parts = [f"{x:02}" if wide else str(x) for x in ((new.day, new.month) if day_first else (new.month, new.day))]
        return sep.join([*parts, str(new.year)]), None
    if full(pii.SSN):
        a, g, n = map(int, m.split("-"))
        y = permute_number(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + n - 1, pii.SSNS, "ssn")
        a = y // (99 * 9999)
        return f"{a + 1 + (a >= 665):03}-{y // 9999 % 99 + 1:02}-{y % 9999 + 1:04}", None
    if m.startswith("+") or full(pii.PHONE_US):
        d = re.sub("[^0-9]", "", m)
        keep = max(len(d) - 10, 0)
        return refill(m, d[:keep] + permute(d[keep:], "phone")), None
    return cards(m, True)


def plain(text):
    if text is None:
        return None, 0
    values = 0

    def one(x):
        nonlocal values
        new, n = pseudonym(x.group())
        values += n if n is not None else new != x.group()
        return new

    return re.sub(pii.FOUND, one, text), values


def texts():
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def with_check(body):
        return body + str(-luhn_sum(body, 0) % 10)

    def iban():
        body = digits(18)
        return "DE" + str(98 - mod97(body + "DE00")).zfill(2) + body

    def one():
        c = with_check("4" + digits(14))
        i = iban()
        return rng.choice([
            f"{rng.choice(['Bob', 'a.b', 'x+y'])}@{rng.choice(['Mail', 'x-1'])}.{rng.choice(['example.com', 'CO.uk', 'a.b.c.d.org', 'x9'])}",
            c, f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}", f"{c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}", digits(16), f"{c} 12/25",
            i, " ".join(i[k:k + 4] for k in range(0, 22, 4)), f"GB12 {digits(4)} ABCD", f"{digits(3)}-{digits(2)}-{digits(4)}",
            f"{rng.randrange(300)}.{rng.randrange(300)}.1.{rng.randrange(300)}", f"{rng.randrange(1890, 2110)}-{rng.randrange(14):02}-{rng.randrange(33):02}",
            f"{rng.randrange(32)}/{rng.randrange(14)}/19{digits(2)}", f"{rng.randrange(32):02}.{rng.randrange(14):02}.20{digits(2)}",
            f"+{rng.randrange(1, 99)} {digits(2)} {digits(4)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"1-{digits(3)}-{digits(3)}-{digits(4)}",
            f"password = {rng.choice(['hunter2x9', 'deadbeef01', 'Ab-9_+/zQ'])}", f"API_KEY:'{digits(4)}abcd{digits(4)}'", "AKIA" + "".join(rng.choice("ABCDEFGH0123") for _ in range(16)),
            "word", "é", digits(3), "1 2 3"])

    return [rng.choice([" ", ", ", "\n", " - "]).join(one() for _ in range(rng.randrange(1, 9))) for _ in range(400)]


def test_whole_documents_equal_the_plain_version(spark):
    rows = [*enumerate(texts()), (-1, None), (-2, ""), (-3, "Bob@X.com bob@x.com BOB@X.com"), (-4, "mail me@" + "a." * 300 + "com now")]
    got = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()
    assert len(got) == len(rows)
    want = {i: plain(t) for i, t in rows}
    for r in got:
        assert (r["text"], r["n_values"]) == want[r["doc_id"]], dict(rows)[r["doc_id"]]
    a, b, c = next(r["text"] for r in got if r["doc_id"] == -3).split(" ")
    assert a.lower() == b == c.lower() and a[0].isupper() and b != "bob@x.com"


N = 10**6
LONG = {"domain": "x@" + "a." * (N // 2) + "com", "label": "a-" * (N // 2), "at": "x@" * (N // 2), "digits": "1" * N, "digit groups": "1 " * (N // 2),
        "plus": "+" * N, "open": "(" * N, "iban": "AB12 " * (N // 5), "local": "a" * N + "@b.com", "secret": "password=" + "a" * N,
        "hyphens": "1-" * (N // 2), "cards": "4041894974608795 " * 6000}


@pytest.mark.parametrize("kind", LONG)
def test_long_texts_return(spark, kind):
    r = pii.pseudonymise(spark.createDataFrame([(1, LONG[kind])], "doc_id long, text string"), KEY).select(
        "n_values", F.length("text").alias("n")).first()
    assert r["n"] == len(LONG[kind])
    assert r["n_values"] == {"secret": 1, "cards": 6000}.get(kind, 0)


def test_key_of_the_session(spark):
    df = spark.createDataFrame([(1, "a1@b2.com")], "doc_id long, text string")
    one = pii.pseudonymise(df).first()["text"]
    assert one == pii.pseudonymise(df).first()["text"]  # the session keeps its key
    kept = spark.conf.get(pii.KEY_SETTING)
    try:
        spark.conf.set(pii.KEY_SETTING, KEY)
        assert pii.pseudonymise(df).first()["text"] == plain("a1@b2.com")[0] == pii.pseudonymise(df, KEY).first()["text"]
    finally:
        spark.conf.set(pii.KEY_SETTING, kept)
