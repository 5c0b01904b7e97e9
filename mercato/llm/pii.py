"""Format-preserving Feistel pseudonyms for personal data, in native
DataFrame functions only (no Python on the executors, no shuffle).

Found: e-mail addresses, IPv4 addresses, phone numbers, payment cards (Luhn),
US social security numbers, IBANs (mod 97), calendar dates 1900-2099, access
keys and the values of password, token, secret and API-key assignments.
Numbers and dates that fail their validation are left alone.  Cards are looked
for at every digit group, in the written forms of ``CARD``, so other numbers
may stand next to them; an IBAN has its country's length.

Each value is permuted by a keyed Feistel network within its own format, so
equal values stay linked across documents and the pseudonym is as valid as
the value was (Luhn and IBAN check digits are recomputed, dates stay calendar
dates, octets stay octets, separators and letter case stay in place):

* strings: the two halves take turns; each character moves within its class
  (digits, a-z, A-Z; a-f for hexadecimal secrets) by a stream that SHA-512
  makes of key, kind, round and the other half;
* dates, addresses and SSNs: the number of the value in its valid range is
  written as (a, b) in mixed radix, and the two parts take turns.

Mail addresses that differ in case alone stay linked up to case.
Kept as they are: the last label of a mail domain, a phone number's country
code (digits before the last ten), a card's first digit, an IBAN's country.

Defined results: null text stays null, with no values; a text without a value
stays as it is, byte for byte.  Rows are independent, so repeats, ties and
extra columns need no care; a carried column ``n_values`` gives way.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark setting that holds the key.  Whoever has the key can invert the
#: pseudonyms, and only equal keys give equal pseudonyms, so runs that must link
#: set it.  Where it is unset, a session makes a random key and keeps it.
KEY_SETTING = "spark.mercato.pseudonym.key"
ROUNDS = 8

#: At most 256 characters before the @, and a domain of at most 127 labels of at
#: most 63 characters: a repeated group without a bound is matched by recursion,
#: and a long text would overflow the stack.
EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,256}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}(?![A-Za-z])")
ASSIGNED = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[ \t]{0,4}[=:][ \t]{0,4}[\"']?)[A-Za-z0-9+/_-]{8,}+"
ACCESS_KEY = r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"
#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" [A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{tail})"


def _layout(*groups: int) -> str:
    return "[ -]".join(f"[0-9]{{{n}}}" for n in groups)


#: With its country's length, so that no word behind it is taken in; else any length.
IBAN = (r"\b(?:" + "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
        + r"|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?))\b")
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
_FIELD = "(?:0?[1-9]|[12][0-9]|3[01])"
DATE_YMD = (r"(?<![0-9/.-])(?:19|20)[0-9]{2}(?:-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
            r"|/(?:0?[1-9]|1[0-2])/(?:0[1-9]|[12][0-9]|3[01]|[1-9]))(?![0-9/-])")
DATE_DMY = ("(?<![0-9/.-])(?:" + "|".join(f"{_FIELD}{sep}{_FIELD}{sep}(?:19|20)[0-9]{{2}}" for sep in ("/", "[.]", "-")) + ")(?![0-9/-])")
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
#: A phone number ends before a card in groups.
_GROUPED = "[ -](?:" + "|".join(_layout(*x) for x in [(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 5, 6)]) + ")(?![0-9])"
PHONE_PLUS = (r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})"
              f"(?:(?!{_GROUPED}(?! ?[0-9]{{4}}(?![0-9])))[ .-]?[0-9]{{2,4}}){{2}}(?:(?!{_GROUPED})[ .-]?[0-9]{{2,4}}){{0,2}}(?![0-9])")
PHONE_US = r"(?<![0-9.+-])(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
#: Digit groups joined by single blanks or hyphens, up to a value of another
#: kind; ``_cards`` finds the cards among them.
DIGITS = ("(?<![0-9])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?:[ -](?!" + "|".join([IP, DATE_YMD, DATE_DMY, SSN, PHONE_US]) + ")[0-9]++)*+")
#: Written forms of cards, each tried at every group of a run of digits.
CARD = "^(?:" + "|".join(["[0-9]{13,19}", *(_layout(*x) for x in [
    (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 5, 6), (4, 4, 5), (4, 3, 3, 3), (8, 8), (6, 10), (6, 13)])]) + ")(?![0-9])"
CARD_19 = "^" + _layout(4, 4, 4, 4, 3) + "(?![0-9])"

#: Most positions of a text fail at the first step of either branch.
FOUND = ("(?<![A-Za-z0-9])(?:" + "|".join([EMAIL, ASSIGNED, ACCESS_KEY, IBAN]) + ")"
         "|(?=[0-9+(])(?:" + "|".join([IP, DATE_YMD, DATE_DMY, SSN, PHONE_PLUS, PHONE_US, DIGITS]) + ")")
#: A text without any of these holds no value.
HINT = "[0-9@=:]"

FIRST_DAY = "1900-01-01"
DAYS = (17, 4297)  # 73,049 days, 1900-01-01 to 2099-12-31
SSNS = (898, 99 * 9999)
ADDRESSES = (1 << 16, 1 << 16)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda's argument is a
    value; an expression named twice would be computed twice)."""
    return F.transform(F.array(value), body)[0]


def _hash(key: str, kind: str, r: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other), 512)


def _char(c: Column, by: Column, hexa: Column) -> Column:
    def turn(base: int, size) -> Column:
        return F.chr(((F.ascii(c) - F.lit(base) + by) % size + F.lit(base)).cast("long"))

    return (F.when(c.rlike("[0-9]"), turn(48, F.lit(10)))
            .when(c.rlike("[a-z]"), turn(97, F.when(hexa, F.lit(6)).otherwise(F.lit(26))))
            .when(c.rlike("[A-Z]"), turn(65, F.lit(26))).otherwise(c))


def _moved(half: Column, stream: Column, hexa: Column) -> Column:
    """Every character of a half, moved within its class by the stream."""
    def each(stream: Column) -> Column:
        def at(c: Column, i: Column) -> Column:
            by = F.conv(F.substring(stream, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int")
            return _char(c, by, hexa)

        return F.array_join(F.transform(F.split(half, ""), at), "")

    return let(stream, each)


def permute(s: Column, key: str, kind: str, hexa: Column | None = None) -> Column:
    """Keyed permutation of the strings with the same character classes."""
    if hexa is not None:
        return let(hexa, lambda h: _permute(s, key, kind, h))
    return _permute(s, key, kind, F.lit(False))


def _permute(s: Column, key: str, kind: str, hexa: Column) -> Column:
    def step(acc: Column, r: Column) -> Column:
        h = F.floor(F.length(acc) / 2).cast("int")
        left, right = F.substring(acc, F.lit(1), h), F.substring(acc, h + 1, F.length(acc))
        return (F.when(r % 2 == 0, F.concat(_moved(left, _hash(key, kind, r, right), hexa), right))
                .otherwise(F.concat(left, _moved(right, _hash(key, kind, r, left), hexa))))

    def run(s: Column) -> Column:
        # a single character has no other half: it moves by the key alone
        one = _moved(s, _hash(key, kind, F.lit(0), F.lit("")), hexa)
        many = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), s, step)
        return F.when(F.length(s) > 1, many).when(F.length(s) == 1, one).otherwise(s)

    return let(s, run)


def permute_number(x: Column, radix: tuple[int, int], key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. radix[0] * radix[1] - 1."""
    a, b = radix

    def step(acc: Column, r: Column) -> Column:
        def moved(own: str, other: str, size: int) -> Column:
            h = F.conv(F.substring(_hash(key, kind, r, acc[other].cast("string")), 1, 14), 16, 10).cast("long")
            return (acc[own] + h) % size

        return F.when(r % 2 == 0, F.struct(moved("a", "b", a).alias("a"), acc["b"].alias("b"))).otherwise(
            F.struct(acc["a"].alias("a"), moved("b", "a", b).alias("b")))

    def run(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("a"), (x % b).cast("long").alias("b"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * b + s["b"])

    return let(x, run)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column, of: str = "[0-9]") -> Column:
    """``m`` with its characters of a class replaced in turn by ``digits``."""
    def each(digits: Column) -> Column:
        def at(i: Column) -> Column:
            c = F.substring(m, i + 1, F.lit(1))
            k = F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), f"[^{of[1:-1]}]", ""))
            return F.when(c.rlike(of), F.substring(digits, k, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(0), F.length(m) - 1), at), "")

    return let(digits, each)


def _luhn_sum(d: Column, first_weight: int) -> Column:
    """Luhn sum of digits, with the weight of the last one."""
    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * F.when((i + first_weight) % 2 == 0, 2).otherwise(1)
        return acc + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def valid(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), permute(F.substring(d, F.lit(2), F.length(d) - 2), key, "card"))
        return _refill(m, let(body, lambda b: F.concat(b, F.pmod(-_luhn_sum(b, 0), F.lit(10)).cast("string"))))

    return let(_digits(m), valid)


def _luhn(m: Column) -> Column:
    return let(_digits(m), lambda d: _luhn_sum(d, 1) % 10 == 0)


def _one(m: Column, new: Column) -> Column:
    """A match and its pseudonym: the text, and the number of values replaced."""
    return let(new, lambda x: F.struct(x.alias("text"), (x != m).cast("long").alias("n")))


def _cards(m: Column, key: str, odd: bool) -> Column:
    """The cards among the digit groups of a match, from the left, each in a
    written form; if there is none and ``odd``, all of 13 to 19 digits, however
    grouped, as one card."""
    def joined(groups: Column, at: Column, n: Column) -> Column:
        return F.array_join(F.slice(groups, at + 1, n), "")

    def first_valid(near: Column) -> Column:
        def size(form: str, other: Column) -> Column:
            return let(F.regexp_extract(near, form, 0), lambda c: F.when(
                (c != "") & _luhn(c), F.size(F.split(c, "[ -]"))).otherwise(other))

        return size(CARD, size(CARD_19, F.lit(0)))

    def placed(groups: Column) -> Column:
        """(first group, number of groups) of every card, none within another."""
        every = F.filter(F.transform(groups, lambda g, i: F.struct(
            i.alias("at"), F.when(g.rlike("^[0-9]"), let(joined(groups, i, F.lit(5)), first_valid)).otherwise(0).alias("n"))),
            lambda c: c["n"] > 0)
        none = F.filter(every, lambda c: F.lit(False))
        return F.aggregate(every, none, lambda acc, c: F.when(
            c["at"] >= F.coalesce(F.get(acc, F.size(acc) - 1)["at"] + F.get(acc, F.size(acc) - 1)["n"], F.lit(0)),
            F.concat(acc, F.array(c))).otherwise(acc))

    def written(groups: Column, cards: Column) -> Column:
        def end(k: Column) -> Column:
            return F.coalesce(F.get(cards, k)["at"] + F.get(cards, k)["n"], F.lit(0))

        new = F.transform(cards, lambda c, k: F.concat(
            joined(groups, end(k - 1), c["at"] - end(k - 1)), _card(joined(groups, c["at"], c["n"]), key)))
        tail = joined(groups, end(F.size(cards) - 1), F.size(groups))
        return F.struct(F.concat(F.array_join(new, ""), tail).alias("text"), F.size(cards).cast("long").alias("n"))

    whole = F.when(F.length(_digits(m)).between(13, 19) & _luhn(m), _one(m, _card(m, key))) if odd else F.when(F.lit(False), _one(m, m))
    none = whole.otherwise(F.struct(m.alias("text"), F.lit(0).cast("long").alias("n")))
    return let(F.regexp_extract_all(m, F.lit("[0-9]+[ -]?|[^0-9]+"), F.lit(0)), lambda groups: let(
        placed(groups), lambda cards: F.when(F.size(cards) > 0, written(groups, cards)).otherwise(none)))


def _phone(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        keep = F.greatest(F.length(d) - 10, F.lit(0))
        return F.concat(F.substring(d, F.lit(1), keep), permute(F.substring(d, keep + 1, F.length(d)), key, "phone"))

    return _refill(m, let(_digits(m), new))


def _mod97(s: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        c = F.substring(s, i + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(0), F.length(s) - 1), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    def checked(s: Column, new: Column) -> Column:
        country = F.substring(s, 1, 2)
        check = let(F.concat(new, country, F.lit("00")), lambda x: F.lpad((F.lit(98) - _mod97(x)).cast("string"), 2, "0"))
        return F.concat(country, check, new)

    def whole(s: Column) -> Column:
        body = F.substring(s, F.lit(5), F.length(s))
        valid = let(F.concat(body, F.substring(s, 1, 4)), _mod97) == 1
        new = _refill(m, let(permute(body, key, "iban"), lambda n: checked(s, n)), "[0-9A-Z]")
        return F.when(valid, _one(m, new)).otherwise(_cards(m, key, odd=False))

    return let(F.replace(m, F.lit(" "), F.lit("")), whole)


def _ip(m: Column, key: str) -> Column:
    number = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda acc, x: acc * 256 + x.cast("long"))
    return let(permute_number(number, ADDRESSES, key, "ip"),
               lambda y: F.concat_ws(".", *[(F.shiftright(y, k) % 256).cast("string") for k in (24, 16, 8, 0)]))


def _ssn(m: Column, key: str) -> Column:
    d = F.transform(F.split(m, "-"), lambda x: x.cast("long"))
    area = d[0] - 1 - F.when(d[0] > 666, 1).otherwise(0)

    def written(y: Column) -> Column:
        a = F.floor(y / F.lit(99 * 9999)).cast("long")
        area = a + 1 + F.when(a >= 665, 1).otherwise(0)
        group = F.floor(y / F.lit(9999)).cast("long") % 99 + 1
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"),
                           F.lpad((y % 9999 + 1).cast("string"), 4, "0"))

    return let(permute_number((area * 99 + d[1] - 1) * 9999 + d[2] - 1, SSNS, key, "ssn"), written)


def _other_day(day: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    return F.date_add(first, permute_number(F.datediff(day, first).cast("long"), DAYS, key, "date").cast("int"))


def _date_ymd(m: Column, key: str) -> Column:
    p = F.split(m, "[/-]")
    sep = F.substring(m, 5, 1)
    wide = (F.length(p[1]) == 2) & (F.length(p[2]) == 2)

    def written(new: Column) -> Column:
        return F.when(wide, F.concat(F.date_format(new, "yyyy"), sep, F.date_format(new, "MM"), sep, F.date_format(new, "dd"))).otherwise(
            F.concat(F.date_format(new, "yyyy"), sep, F.month(new).cast("string"), sep, F.dayofmonth(new).cast("string")))

    return let(F.try_to_date(F.concat_ws("-", p[0], F.lpad(p[1], 2, "0"), F.lpad(p[2], 2, "0")), "yyyy-MM-dd"),
               lambda day: F.when(day.isNotNull(), let(_other_day(day, key), written)).otherwise(m))


def _date_dmy(m: Column, key: str) -> Column:
    """Day first with dots or hyphens or if the second field is no month, else
    month first if the first field may be one (with slashes), as they are
    written."""
    p = F.split(m, "[/.-]")
    sep = F.regexp_extract(m, "[/.-]", 0)
    day_first = F.when(sep != "/", p[1].cast("int") <= 12).otherwise(p[0].cast("int") > 12)
    d, mo = F.when(day_first, p[0]).otherwise(p[1]), F.when(day_first, p[1]).otherwise(p[0])
    day = F.try_to_date(F.concat_ws("-", p[2], F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    def written(new: Column) -> Column:
        wide = (F.length(p[0]) == 2) & (F.length(p[1]) == 2)
        nd, nm = F.dayofmonth(new).cast("string"), F.month(new).cast("string")
        nd, nm = F.when(wide, F.lpad(nd, 2, "0")).otherwise(nd), F.when(wide, F.lpad(nm, 2, "0")).otherwise(nm)
        year = F.year(new).cast("string")
        return F.when(day_first, F.concat(nd, sep, nm, sep, year)).otherwise(F.concat(nm, sep, nd, sep, year))

    return let(day, lambda x: F.when(x.isNotNull(), let(_other_day(x, key), written)).otherwise(m))


def _email(m: Column, key: str) -> Column:
    """The address in lower case is permuted, and the capitals put back where
    they were: addresses that differ in case stay linked."""
    head = F.regexp_extract(m, r"^(.*)(\.[A-Za-z]+)$", 1)
    tail = F.regexp_extract(m, r"^(.*)(\.[A-Za-z]+)$", 2)
    return let(head, lambda h: F.concat(F.array_join(F.zip_with(
        F.split(permute(F.lower(h), key, "email"), ""), F.split(h, ""),
        lambda new, old: F.when(old.rlike("[A-Z]"), F.upper(new)).otherwise(new)), ""), tail))


def _assigned(m: Column, key: str) -> Column:
    whole = r"^(.*[=:][ \t]{0,4}[\"']?)([A-Za-z0-9+/_-]+)$"
    value = F.regexp_extract(m, whole, 2)
    return F.concat(F.regexp_extract(m, whole, 1), permute(value, key, "secret", value.rlike("^[0-9a-f]+$")))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of FOUND (the match itself if not valid) and
    the number of values replaced in it."""
    def whole(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")

    access = F.concat(F.substring(m, 1, 4), permute(F.substring(m, 5, 16), key, "access"))
    return (F.when(whole(EMAIL), _one(m, _email(m, key)))
            .when(m.rlike("^(?i:password|passwd|pwd|secret|token|api)"), _one(m, _assigned(m, key)))
            .when(whole(ACCESS_KEY), _one(m, access))
            .when(m.rlike("^[A-Z]{2}"), _iban(m, key))
            .when(whole(IP), _one(m, _ip(m, key)))
            .when(whole(DATE_YMD), _one(m, _date_ymd(m, key)))
            .when(whole(DATE_DMY), _one(m, _date_dmy(m, key)))
            .when(whole(SSN), _one(m, _ssn(m, key)))
            .when(m.startswith("+") | whole(PHONE_US), _one(m, _phone(m, key)))
            .otherwise(_cards(m, key, odd=True)))


def key_of(spark: SparkSession) -> str:
    """The session's key (see KEY_SETTING)."""
    if not (key := spark.conf.get(KEY_SETTING, None)):
        spark.conf.set(KEY_SETTING, key := secrets.token_hex(32))
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with its text pseudonymised and ``n_values``, the number of
    values replaced.  Other columns pass through.  Without a ``key``, the
    session's is taken."""
    key = key or key_of(docs.sparkSession)
    t = F.col(f"`{text}`")
    holds = F.coalesce(t.rlike(HINT), F.lit(False))
    found = docs.withColumn("_found", F.when(holds, F.regexp_extract_all(t, F.lit(FOUND), F.lit(0))))
    some = F.coalesce(F.size("_found") > 0, F.lit(False))
    found = (found.withColumn("_new", F.when(some, F.transform("_found", lambda m: pseudonym(m, key))))
             .withColumn("_gaps", F.when(some, F.split(t, FOUND, -1))))
    new = F.array_join(F.zip_with("_gaps", "_new", lambda g, m: F.concat(g, F.coalesce(m["text"], F.lit("")))), "")
    changed = F.aggregate("_new", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    return (found.withColumn("n_values", F.when(some, changed).otherwise(F.lit(0).cast("long")))
            .withColumn(text, F.when(some, new).otherwise(t)).drop("_found", "_new", "_gaps"))
