"""PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

One pattern finds candidates; each kind has its check, and what passes is replaced by a keyed
permutation within its format, so equal values have equal pseudonyms in all documents and different
values different ones:

* card     - 13 to 19 digits that pass the Luhn test, in one piece or in groups of 4-4-4-4, with 1 to 3 more,
             4-6-5 or 4-6-4: the digits between the first and the check digit are permuted, the check
             digit is made anew.  A group after 4-4-4-4 belongs to the card if all pass, else the 16 are tried;
* iban     - passes the mod-97 test, in one piece or, for the countries of ``IBAN_LENGTHS``, in groups of
             four: the account part is permuted symbol by symbol, the check anew;
* ssn      - a valid area, group and serial number go to valid ones;
* phone    - 3-3-4 digits, with a country code or without: the code and the first digits of area and exchange
             stay, the other eight are permuted.  After + and a country code also pairs (1-2-2-2-2), three
             groups (2 to 4, 3 or 4, 3 or 4), an area of 1 to 5 digits and 4 to 8 more, or 8 to 15 digits in one
             piece: the code and a digit stay (three digits of one piece), the others are permuted;
* ipv4     - four numbers up to 255, as one 32-bit number;
* date     - a day from 1800-01-01 to 2199-12-31 (146,097 days, 189 * 773) goes to another such day in
             the same layout (yyyy-mm-dd, dd/mm/yyyy or, where that is no day, mm/dd/yyyy, dd.mm.yyyy);
* email    - letters and digits of the part before the @, symbol by symbol.

Candidates that fail their check stay as they are.  The permutation is a Feistel network of ``ROUNDS``
rounds on two halves (numbers, or symbols each shifted within its own alphabet) with SHA-256 of key,
kind, round and the other half as round function.

Defined results.  A NULL text stays NULL with no values; an empty text stays empty.  Repeated rows get
equal texts.  Extra columns are passed on.  The key is a secret of the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .register import query

ROUNDS = 8

#: Symbols of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
GROUPED_IBAN = "|".join(
    f"(?:{countries.replace(' ', '|')})\\d{{2}}(?:[ -][A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, countries in IBAN_LENGTHS.items())

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){1,9}",
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d{2})(?:[A-Z]{2}\d{2}[A-Z0-9]{11,30}|" + GROUPED_IBAN + ")(?![A-Za-z0-9])",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])",
    "ipv4": r"(?<!\d)(?<!\d\.)\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?:[ -]\d{1,3}(?!\d|[ ./-]\d))?|"
            r"\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?:\+\d{1,3}[ .-]?|(?<![\d-]))(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
             r"|\+\d{1,3}[ .-]\d(?:[ .-]\d{2}){4}(?!\d|[./-]\d)"
             r"|\+\d{1,3}[ .-](?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d|[./-]\d)"
             r"|\+\d{1,3}[ .-](?:\(\d{1,5}\)[ .-]?|\d{1,5}[ .-])\d{4,8}(?!\d)"
             r"|\+\d{8,15}(?!\d)",
}
ANY = "|".join(PATTERNS.values())
KINDS = list(PATTERNS)
PHONE_PARTS = r"^(\+\d{1,3}[ .-]?)?(\(?)(\d)(\d\d)(\)?[ .-]?)(\d)(\d\d)([ .-])(\d{4})$"

CARD_AND_GROUP = r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}$"

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _prf(key: str, kind: str, turn: Column, *data: Column) -> Column:
    """60 keyed bits of the data."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), *[d.cast("string") for d in data])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel_numbers(a: Column, b: Column, size_a: int, size_b: int, key: str, kind: str) -> Column:
    """A permutation of the pairs (a, b) with a < size_a and b < size_b, as a struct."""
    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        left = F.when(even, F.pmod(s["a"] + F.pmod(_prf(key, kind, i, s["b"]), F.lit(size_a)), F.lit(size_a))).otherwise(s["a"])
        right = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + F.pmod(_prf(key, kind, i, s["a"]), F.lit(size_b)), F.lit(size_b)))
        return F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _shifted(half: Column, other: Column, key: str, kind: str, turn: Column) -> Column:
    """Every letter or digit moved within its alphabet by a keyed amount; other symbols stay."""
    def move(symbol: Column, at: Column) -> Column:
        out = symbol
        amount = _prf(key, kind, turn, at, F.length(half), other)
        for alphabet in (LOWER, UPPER, DIGITS):
            size = F.lit(len(alphabet))
            place = F.position(symbol, F.lit(alphabet))
            to = F.pmod(place - 1 + F.pmod(amount, size), size) + 1
            out = F.when(place > 0, F.substring(F.lit(alphabet), to.cast("int"), F.lit(1))).otherwise(out)
        return out
    symbols = F.filter(F.split(half, ""), lambda c: c != "")
    return F.array_join(F.transform(symbols, move), "")


def feistel_text(text: Column, key: str, kind: str) -> Column:
    """A permutation of the texts of the same layout."""
    middle = F.floor(F.length(text) / 2).cast("int")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shifted(s["a"], s["b"], key, kind, i)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(_shifted(s["b"], s["a"], key, kind, i)).alias("b"))

    start = F.struct(F.substring(text, F.lit(1), middle).alias("a"),
                     F.substring(text, middle + 1, F.length(text)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits whose last one is the check digit."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    worth = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda s, x: s + x)


def _fill(layout: Column, new: Column, separators: str = r"\D") -> Column:
    """The layout with its digits, or all that is no separator, replaced in order."""
    symbols = F.filter(F.split(layout, ""), lambda c: c != "")
    return F.array_join(F.transform(symbols, lambda c, i: F.when(~c.rlike(separators), F.substring(
        new, F.length(F.regexp_replace(F.substring(layout, F.lit(1), i + 1), separators, "")), F.lit(1))).otherwise(c)), "")


def _mod97(text: Column) -> Column:
    symbols = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(symbols, F.lit(0), lambda s, c: F.when(
        c.rlike(r"\d"), (s * 10 + F.position(c, F.lit(DIGITS)) - 1) % 97).otherwise(
        (s * 100 + F.position(c, F.lit(UPPER)) + 9) % 97))


def _day(text: Column) -> tuple[Column, Column]:
    """Days since 1800-01-01 (NULL: no such day) and the layout."""
    layouts = [(r"^\d{4}-", "yyyy-MM-dd"), (r"/", "dd/MM/yyyy"), (r"/", "MM/dd/yyyy"), (r"\.", "dd.MM.yyyy")]
    day, layout = F.lit(None).cast("int"), F.lit(None).cast("string")
    for mark, form in reversed(layouts):
        parsed = F.datediff(F.try_to_timestamp(text, F.lit(form)).cast("date"), F.lit("1800-01-01").cast("date"))
        fits = text.rlike(mark) & parsed.between(0, 146096)
        day, layout = F.when(fits, parsed).otherwise(day), F.when(fits, F.lit(form)).otherwise(layout)
    return day, layout


def _card(v: Column, key: str) -> Column:
    whole = _digits(v)
    tried = F.when((_luhn_sum(whole) % 10 != 0) & v.rlike(CARD_AND_GROUP), F.substring(whole, 1, 16)).otherwise(whole)

    def made(digits: Column) -> Column:
        n = F.length(digits)
        body = F.concat(F.substring(digits, 1, 1), feistel_text(F.substring(digits, F.lit(2), n - 2), key, "card"))
        check = F.pmod(F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
        rest = F.substring(whole, n + 1, F.length(whole))
        return F.when(_luhn_sum(digits) % 10 == 0, _fill(v, F.concat(body, check.cast("string"), rest)))
    return F.transform(F.array(tried), made)[0]


def _iban(v: Column, key: str) -> Column:
    def made(packed: Column) -> Column:
        country, account = F.substring(packed, 1, 2), F.substring(packed, F.lit(5), F.length(packed))
        valid = _mod97(F.concat(account, F.substring(packed, 1, 4))) == 1
        new = feistel_text(account, key, "iban")
        check = F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))
        return F.when(valid, _fill(v, F.concat(country, F.lpad(check.cast("string"), 2, "0"), new), "[ -]"))
    return F.transform(F.array(F.regexp_replace(v, "[ -]", "")), made)[0]


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substring(v, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    new = feistel_numbers(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, 898, 989901, key, "ssn")
    shown = F.transform(F.array(new), lambda s: F.format_string(
        "%03d-%02d-%04d", s["a"] + F.when(s["a"] >= 665, 2).otherwise(1),
        F.floor(s["b"] / 9999) + 1, s["b"] % 9999 + 1))[0]
    return F.when(valid, shown)


def _phone(v: Column, key: str) -> Column:
    part = [F.regexp_extract(v, PHONE_PARTS, k) for k in range(10)]
    new = feistel_text(F.concat(part[4], part[7], part[9]), key, "phone")
    shown = F.transform(F.array(new), lambda p: F.concat(
        part[1], part[2], part[3], F.substring(p, 1, 2), part[5], part[6], F.substring(p, 3, 2), part[8],
        F.substring(p, 5, 4)))[0]
    digits = _digits(v)
    stay = F.when(v.rlike(r"^\+\d+$"), 3).otherwise(F.length(F.regexp_extract(v, r"^\+(\d+)", 1)) + 1)
    other = F.concat(F.substring(digits, F.lit(1), stay),
                     feistel_text(F.substring(digits, stay + 1, F.length(digits)), key, "phone"))
    return F.when(v.rlike(PHONE_PARTS), shown).otherwise(_fill(v, other))


def _ipv4(v: Column, key: str) -> Column:
    octets = F.transform(F.split(v, r"\."), lambda o: o.cast("int"))
    new = feistel_numbers(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65536, 65536, key, "ipv4")
    shown = F.transform(F.array(new), lambda s: F.concat_ws(".", *[
        x.cast("long").cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)]))[0]
    return F.when(F.forall(octets, lambda o: o <= 255), shown)


def _date(v: Column, key: str) -> Column:
    day, layout = _day(v)
    new = feistel_numbers(F.floor(day / 773), day % 773, 189, 773, key, "date")
    out = F.transform(F.array(new), lambda s: F.date_add(F.lit("1800-01-01").cast("date"), (s["a"] * 773 + s["b"]).cast("int")))[0]
    shown = F.lit(None).cast("string")
    for form in ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy"):
        shown = F.when(layout == form, F.date_format(out, form)).otherwise(shown)
    return F.when(day.isNotNull(), shown)


def _email(v: Column, key: str) -> Column:
    local = F.substring_index(v, "@", 1)
    return F.when(local.rlike("[A-Za-z0-9]"), F.concat(feistel_text(local, key, "email"), F.substring(v, F.length(local) + 1, F.length(v))))


MAKERS = {"email": _email, "iban": _iban, "date": _date, "ipv4": _ipv4, "card": _card, "ssn": _ssn, "phone": _phone}


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, new): the pseudonym of one candidate; kind is NULL where it fails its check."""
    new, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in reversed(KINDS):
        made = MAKERS[name](value, key)
        fits = value.rlike(f"^(?:{PATTERNS[name]})$")
        new = F.when(fits, made).otherwise(new)
        kind = F.when(fits, F.lit(name)).otherwise(kind)
    return F.transform(F.array(F.struct(kind.alias("kind"), new.alias("new"))), lambda s: F.struct(
        F.when(s["new"].isNotNull(), s["kind"]).alias("kind"), F.coalesce(s["new"], value).alias("new")))[0]


def pseudonymise(documents: DataFrame, key: str, text_col: str = "text", values_col: str | None = None) -> DataFrame:
    """The documents in their own columns, the text with pseudonyms; ``values_col`` names a further
    column with the kinds of the replaced values in order."""
    text = F.col("row").getField(text_col)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    found = rows.withColumn("made", F.when(text.rlike(ANY), F.transform(
        F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)), lambda v: pseudonym(v, key))))
    pieces = F.split(text, ANY, -1)
    joined = F.concat(F.array_join(F.zip_with(
        F.slice(pieces, F.lit(1), F.size("made")), "made", lambda p, m: F.concat(p, m["new"])), ""), F.element_at(pieces, -1))
    new = F.when(F.col("made").isNotNull(), joined).otherwise(text)
    kinds = F.coalesce(F.filter(F.transform("made", lambda m: m["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    columns = [(new if c == text_col else F.col("row").getField(c)).alias(c) for c in documents.columns]
    return found.select(*columns, *([kinds.alias(values_col)] if values_col else []))


#: The key of the registered query; a real run passes its own secret.
QUERY_KEY = "public key of the registered query"


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pseudonymise(documents, QUERY_KEY, values_col="kinds")
    counts = [F.expr(f"cast(size(filter(kinds, k -> k = '{name}')) AS long) AS n_{name}") for name in KINDS]
    return out.select("doc_id", "text", *counts)
