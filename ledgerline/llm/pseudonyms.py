"""PII: format-preserving Feistel pseudonyms with built-in functions only.

Validated values are permuted within their format under a key: a card number
becomes another number that passes the Luhn check, a bank account number
(IBAN) another with right check digits, an address another address, a date
another date. The permutation is the same everywhere, so
equal values stay equal across documents and can be linked, and different
values stay different.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import column
from ledgerline.llm.feistel import ROUNDS, WALK, cycle_walk, permute

#: The session setting that holds the key.
KEY_CONF = "spark.ledgerline.pseudonym.key"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
#: A secret of any length, 16 characters at least: letters, digits and +/_~%-, between them also marks such as the dots of a
#: signed token, '=' at the end. Each part is possessive, so that a long value is read once and without recursion.
SECRET = r"(?=[A-Za-z0-9+/_~%.=:!#$*^-]{15}[A-Za-z0-9+/_~%=-])[A-Za-z0-9+/_~%-]++(?:[.=:!#$*^]++[A-Za-z0-9+/_~%-]++)*+=*+"
#: The next group of a phone number after a space does not begin another value: address, date, card, social security number, phone number.
NEXT = (r"(?! (?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])|[0-9]{4}[/-][0-9]{1,2}[/-]|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{4}(?:[ -][0-9]{4}){3}"
        r"|[0-9]{4}[ -][0-9]{6}[ -]|[0-9]{13}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}))")
#: Words that make the number after them something else than an address, or than a phone number in national groups.
NO_IP = (r"(?=[0-9]{1,3}\.[0-9]{1,3}\.[0-9])(?<!(?<![A-Za-z])(?i:version|versions|release|build|firmware|section|chapter|clause)[ :]{1,2})"
         r"(?<!(?<![A-Za-z])(?i:ver|rev|v)[. :]{0,2})")
NO_PHONE = (r"(?=[0-9]{1,4}[ ./-][0-9])(?<!(?<![A-Za-z])(?i:order|invoice|ticket|item|part|serial|model|batch|lat|latitude|lon|longitude|isbn|issn)"
            r"(?i: no| nr| number)?[.:]? ?[#:]? ?)(?<!#)")
#: Phone numbers: with a country code in one piece, in groups, with an area code in brackets; then the national forms, which are
#: no part of a longer row of numbers: area codes in brackets, three and three and four digits, and those with a leading 0.
PHONES = (
    r"(?<![0-9])\+[1-9][0-9]{7,14}(?![0-9])",
    r"(?<![0-9])(?:\+?1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    rf"(?<![0-9])\+[1-9][0-9]{{0,2}}[ .-]?\([0-9]{{1,5}}\)[ .-]?[0-9]{{2,8}}(?:{NEXT}[ .-][0-9]{{2,8}}){{0,4}}(?![0-9])",
    rf"(?<![0-9])\+[1-9][0-9]{{0,2}}(?:[ .-][0-9])?[ .-][0-9]{{2,4}}(?:{NEXT}[ .-][0-9]{{2,4}}){{1,3}}(?![0-9])",
    rf"(?<![0-9])\+[1-9][0-9]{{0,2}}(?:[ .-][0-9]{{1,5}})?{NEXT}[ .-][0-9]{{5,12}}(?![0-9])",
    rf"\(0[0-9]{{1,4}}\)[ .-]?[0-9]{{3,4}}(?:{NEXT}[ .-])?[0-9]{{3,5}}(?![0-9])",
    NO_PHONE + r"(?<![0-9])(?<![0-9][.-])(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9]|[.-][0-9])",
    NO_PHONE + r"(?<![0-9])(?<![0-9][.-])(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9]|[.-][0-9])",
    NO_PHONE + r"(?<![0-9])(?<![0-9][ .-])(?:1 )?[0-9]{3} [0-9]{3}[ -][0-9]{4}(?![0-9]|[ .-][0-9])",
    NO_PHONE + r"(?<![0-9])(?<![0-9][ .-])0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ -]?[0-9]{3,5}(?![0-9]|[ .-][0-9])",
    NO_PHONE + r"(?<![0-9])(?<![0-9][ .-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9]|[ .-][0-9])",
)
#: What stands before the number within a country: its code (ITU-T E.164, as assigned), a leading 1 or 0.
COUNTRY = (r"^(\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})(?:[ .-]?\(0\))?[ .-]?\(?0?"
           r"|1(?=[ .-]?\()|1[ .-](?=[0-9]{3}[ .-])|\(?0|)")
#: What is looked for, in order; a place belongs to the first kind that fits it.
PATTERNS = {
    "email": EMAIL,
    "secret": rf"(?<![A-Za-z0-9])(?i:token|secret|passwd|password|api_?key)\s{{0,3}}[=:]\s{{0,3}}[\"']?(?!{EMAIL}){SECRET}",
    "access_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}(?: ?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?: ?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": "|".join(PHONES),
    "ip": NO_IP + r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}|[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)(?:19|20)[0-9]{2})(?![0-9/-])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
#: All kinds in one pattern; the look ahead spares most places most kinds.
ANY = (f"(?=[A-Za-z0-9])(?:{PATTERNS['email']}|{PATTERNS['secret']})|"
       f"(?=[A-Z]{{2}})(?:{PATTERNS['access_key']}|{PATTERNS['iban']})|(?=[0-9+(])(?:"
       + "|".join(f"(?:{PATTERNS[k]})" for k in ("phone", "ip", "date", "ssn", "card")) + ")")
#: Every match holds one of these; a text without them is not searched.
HINT = "[0-9@=:]|A[KS]IA"
#: What stands before a secret.
NAMED = r"^([A-Za-z_]+\s{0,3}[=:]\s{0,3}[\"']?)"
#: Dates range over the months from 1900-01 to 2099-12. The days up to DOZEN change places among themselves, and so do the later
#: ones: a pseudonym with the day first can then be told from one with the month first just as the value itself.
MONTHS, DOZEN, LATER = 2_400, 12, 19
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef",)
CAPITALS = (ALPHABETS[2] + ALPHABETS[0],)
#: Social security numbers: areas 001-899 without 666, groups 01-99, serials 0001-9999.
AREAS, GROUPS, SERIALS = 898, 99, 9_999
#: A half longer than this counts by its SHA-256 in a round, so that a long text takes time in proportion to its length.
HALF = 64


def _draw(*parts: Column) -> Column:
    """44 bits of the SHA-256 of the parts, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 11), 16, 10).cast("long")


def permute_text(s: Column, key: str, alphabets: tuple[str, ...] = ALPHABETS) -> Column:
    """A Feistel network over the two halves of a text.

    Each round moves every letter of one half within its alphabet by a keyed
    function of the other half and of the place; other characters stay. The
    halves and the alphabets do not change, so each round can be undone.
    """
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"), F.substr(s, half + 1, F.length(s)).alias("r"))

    def moved(part: Column, other: Column, turn: Column) -> Column:
        def letter(ch: Column, at: Column) -> Column:
            v, out = _draw(F.lit(key), turn.cast("string"), at.cast("string"), other), ch
            for a in alphabets:
                spot = F.instr(F.lit(a), ch)
                out = F.when(spot > 0, F.substr(F.lit(a), (F.pmod(spot - 1 + v, F.lit(len(a))) + 1).cast("int"), F.lit(1))).otherwise(out)
            return out
        return F.array_join(F.transform(F.split(part, ""), letter), "")

    def turned(part: Column, full: Column, turn: Column) -> Column:
        short = F.when(F.length(full) > HALF, F.sha2(full.cast("binary"), 256)).otherwise(full)
        # one fold over a single element, so that the digest is taken once and not for each letter
        return F.when(F.length(part) == 0, part).otherwise(F.aggregate(F.array(short), F.lit(""), lambda _, o: moved(part, o, turn)))

    def step(acc: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(F.when(even, turned(acc["l"], acc["r"], turn)).otherwise(acc["l"]).alias("l"),
                        F.when(even, acc["r"]).otherwise(turned(acc["r"], acc["l"], turn)).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """The Luhn sum of a digit text, counted from the right; the first digit there is doubled or not."""
    def value(ch: Column, at: Column) -> Column:
        d = ch.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(at % 2 == (0 if doubled_first else 1), twice).otherwise(d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, v: a + v)


def luhn_valid(s: Column) -> Column:
    return _luhn_sum(F.regexp_replace(s, "[^0-9]", ""), False) % 10 == 0


def _keyed(key: str):
    return lambda half, mult, offset: _draw(F.lit(key), mult.cast("string"), offset.cast("string"), half.cast("string"))


def pseudonym_card(s: Column, key: str) -> Column:
    body = permute_text(F.substr(s, F.lit(1), F.length(s) - 1), key + "|card", ALPHABETS[:1])
    check = (10 - _luhn_sum(F.regexp_replace(body, "[^0-9]", ""), True) % 10) % 10
    return F.concat(body, check.cast("string"))


def _mod_97(s: Column) -> Column:
    """The remainder by 97 of a text of digits and capitals, where A is 10 and Z is 35."""
    def step(acc: Column, ch: Column) -> Column:
        v = F.instr(F.lit(ALPHABETS[0] + ALPHABETS[2]), ch) - 1
        return F.when(v < 10, acc * 10 + v).otherwise(acc * 100 + v) % 97
    return F.aggregate(F.split(s, ""), F.lit(0), step)


def iban_valid(s: Column) -> Column:
    """The remainder fits, and there are 15 to 34 characters and check digits from 02 to 98, of which each number has one."""
    bare = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(4)))
    return F.length(bare).between(15, 34) & F.substring(bare, 3, 2).between("02", "98") & (_mod_97(turned) == 1)


def pseudonym_iban(s: Column, key: str) -> Column:
    """The country stays, the account moves within its format, the check digits follow."""
    country = F.substring(s, 1, 2)
    account = permute_text(F.substr(s, F.lit(5), F.length(s)), key + "|iban")
    check = 98 - _mod_97(F.concat(F.replace(account, F.lit(" "), F.lit("")), country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)


def pseudonym_ssn(s: Column, key: str) -> Column:
    """A permutation of the valid numbers, by their rank."""
    area, group, serial = (F.substring(s, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    rank = ((area - F.when(area > 666, 2).otherwise(1)) * GROUPS + group - 1) * SERIALS + serial - 1
    p = cycle_walk(rank, AREAS * GROUPS * SERIALS, key + "|ssn", _keyed(key + "|ssn"))
    parts = F.struct(F.call_function("div", p, F.lit(GROUPS * SERIALS)).alias("a"), F.pmod(F.call_function("div", p, F.lit(SERIALS)), F.lit(GROUPS)).alias("g"),
                     F.pmod(p, F.lit(SERIALS)).alias("n"))
    # one fold over a single element, so that the walk is written once
    return F.aggregate(F.array(parts), F.lit(""), lambda _, x: F.concat_ws(
        "-", F.lpad((x["a"] + F.when(x["a"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((x["g"] + 1).cast("string"), 2, "0"), F.lpad((x["n"] + 1).cast("string"), 4, "0")))


def pseudonym_ip(s: Column, key: str) -> Column:
    four = F.split(s, r"\.")
    number = F.aggregate(four, F.lit(0).cast("long"), lambda a, v: a * 256 + v.cast("long"))
    p = permute(number, 65_536, 65_536, key + "|ip", _keyed(key + "|ip"))
    return F.aggregate(F.array(*[F.lit(8 * i) for i in (2, 1, 0)]),
                       F.struct(F.call_function("div", p, F.lit(1 << 24)).cast("string").alias("t"), p.alias("p")),
                       lambda acc, bits: F.struct(F.concat_ws(".", acc["t"], (F.call_function("shiftright", acc["p"], bits).bitwiseAND(F.lit(255))).cast("string")).alias("t"), acc["p"].alias("p")),
                       lambda acc: acc["t"])


def _date_of(s: Column) -> tuple[Column, Column]:
    """(the date or null, its format). Slash dates have the month first unless only the day can be."""
    parts, sep = F.split(s, "[./-]"), F.regexp_extract(s, "[./-]", 0)

    def look(letter: str, at: int, other: int) -> Column:
        own, two = parts[at], F.length(parts[other]) == 2
        return F.when(own.startswith("0") | (F.length(own) == 2) & two, letter * 2).otherwise(letter)

    def fmt_of(day: int, month: int) -> list[Column]:
        return [look("d", day, month), look("M", month, day)]

    year_first, day_first, month_first = fmt_of(2, 1), fmt_of(0, 1), fmt_of(1, 0)
    fmt = (F.when(s.rlike("^[0-9]{4}"), F.concat(F.lit("yyyy"), sep, year_first[1], sep, year_first[0]))
           .when((sep == ".") | (parts[0].cast("int") > 12), F.concat(day_first[0], sep, day_first[1], sep, F.lit("yyyy")))
           .otherwise(F.concat(month_first[1], sep, month_first[0], sep, F.lit("yyyy"))))
    return F.try_to_timestamp(s, fmt).cast("date"), fmt


def _day_at(p: Column, first: int, n: int) -> Column:
    """The day of place p among the days first .. first + n - 1 of all months; null if its month is too short."""
    start = F.add_months(F.lit("1900-01-01").cast("date"), F.call_function("div", p, F.lit(n)).cast("int"))
    at = (F.pmod(p, F.lit(n)) + first).cast("int")
    return F.when(F.dayofmonth(F.last_day(start)) >= at, F.date_add(start, at - 1))


def pseudonym_date(s: Column, key: str) -> Column:
    """A permutation of the days, written as the value is."""
    def moved(x: Column) -> Column:
        month, at = (F.year(x["day"]) - 1900) * 12 + F.month(x["day"]) - 1, F.dayofmonth(x["day"])

        def turn(p: Column) -> Column:
            return permute(p, MONTHS, LATER, key + "|late date", _keyed(key + "|late date"))

        early = permute((month * DOZEN + at - 1).cast("long"), MONTHS, DOZEN, key + "|date", _keyed(key + "|date"))
        first = turn((month * LATER + at - DOZEN - 1).cast("long"))
        late = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first,  # until the month has such a day
                           lambda acc, _: F.when(_day_at(acc, DOZEN + 1, LATER).isNull(), turn(acc)).otherwise(acc),
                           lambda acc: F.coalesce(_day_at(acc, DOZEN + 1, LATER), F.raise_error(F.lit("cycle walk did not end")).cast("date")))
        new = F.when(at <= DOZEN, _day_at(early, 1, DOZEN)).otherwise(late)
        return F.call_function("date_format", new, x["fmt"])

    day, fmt = _date_of(s)
    # one fold over a single element, so that the value is read once
    return F.aggregate(F.array(F.struct(day.alias("day"), fmt.alias("fmt"))), F.lit(None).cast("string"), lambda _, x: F.when(x["day"].isNotNull(), moved(x)))


def pseudonym_phone(s: Column, key: str) -> Column:
    """The digits after the country code or the leading 1 or 0 move, equal digits alike however the number is written."""
    fixed = F.regexp_extract(s, COUNTRY, 1)
    rest = F.substr(s, F.length(fixed) + 1, F.length(s))
    digits = permute_text(F.regexp_replace(rest, "[^0-9]", ""), key + "|phone", ALPHABETS[:1])

    def put(acc: Column, ch: Column) -> Column:
        digit = ch.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substring(acc["left"], 1, 1)).otherwise(ch)).alias("out"),
                        F.when(digit, F.substr(acc["left"], F.lit(2), F.length(acc["left"]))).otherwise(acc["left"]).alias("left"))

    return F.aggregate(F.split(rest, ""), F.struct(fixed.alias("out"), digits.alias("left")), put, lambda acc: acc["out"])


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting KEY_CONF. Unset, a secret one is drawn and kept for the session.

    Who wants equal pseudonyms in more than one run gives a key; no key stands in the library.
    """
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_CONF, key)
    return key


def kind_of(s: Column) -> Column:
    """The kind of a match, or null if it does not validate (no Luhn number, no such day)."""
    def whole(kind: str) -> Column:
        return s.rlike(f"^(?:{PATTERNS[kind]})$")
    return (F.when(F.instr(s, "@") > 0, "email").when(whole("phone"), "phone").when(whole("ip"), "ip")
            .when(whole("date"), F.when(_date_of(s)[0].isNotNull(), "date")).when(whole("ssn"), "ssn")
            .when(whole("access_key"), "access_key").when(whole("iban"), F.when(iban_valid(s), "iban"))
            .when(whole("card"), F.when(luhn_valid(s), "card"))
            .when(s.rlike(NAMED), "secret"))


def pseudonym_of(s: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a validated value, another value of the same kind and format; else the value itself."""
    local = F.substring_index(s, "@", 1)
    named = F.regexp_extract(s, NAMED, 1)
    secret = F.substr(s, F.length(named) + 1, F.length(s))
    return (F.when(kind == "email", F.concat(permute_text(local, key + "|email"), F.substr(s, F.length(local) + 1, F.length(s))))
            .when(kind == "phone", pseudonym_phone(s, key))
            .when(kind == "ip", pseudonym_ip(s, key)).when(kind == "date", pseudonym_date(s, key))
            .when(kind == "card", pseudonym_card(s, key)).when(kind == "ssn", pseudonym_ssn(s, key)).when(kind == "iban", pseudonym_iban(s, key))
            .when(kind == "access_key", F.concat(F.substring(s, 1, 4), permute_text(F.substr(s, F.lit(5), F.length(s)), key + "|access_key", CAPITALS)))
            .when(kind == "secret", F.concat(named, F.when(secret.rlike("^[0-9a-f]+$"), permute_text(secret, key + "|hex", HEX)).otherwise(permute_text(secret, key + "|secret"))))
            .otherwise(s))


def pseudonymise(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_found, kinds for every row of ``docs``, other columns ignored.

    ``text`` with every validated value replaced, null for null; numbers that
    fail their check stay. ``kinds``: the kind of each replaced value in text
    order; ``n_found``: how many. Repeated rows get equal results. ``key``: that
    of the session (see session_key) unless given.
    """
    key = key or session_key(docs.sparkSession)
    text = column(docs, text_col)
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    parts = docs.select(column(docs, id_col).alias("doc_id"), text.alias("text"),
                        F.transform(found, lambda m: F.struct(m.alias("m"), kind_of(m).alias("k"))).alias("found"))
    new = F.transform("found", lambda f: pseudonym_of(f["m"], f["k"], key))
    between = F.split(F.col("text"), ANY, -1)
    glued = F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size("found")), new, lambda a, b: F.concat(a, b)), ""), F.element_at(between, -1))
    kinds = F.filter(F.transform("found", lambda f: f["k"]), lambda k: k.isNotNull())
    return parts.select("doc_id", F.when(F.size("found") == 0, F.col("text")).otherwise(glued).alias("text"),
                        F.size(kinds).cast("long").alias("n_found"), kinds.alias("kinds"))
