"""Format-preserving pseudonyms for personal data.

One pattern finds candidates: payment cards, phone numbers, IPv4 addresses, social security numbers, IBANs, dates and
e-mail addresses. Numbers and dates are validated (Luhn, mod 97, ranges, the calendar) and what fails stays as
it is. What remains is put through a keyed Feistel permutation of its own format: digits stay digits, letters stay
letters, separators stay in place, check digits are computed anew, a date stays a date in the same layout. The
permutation depends on the key, the kind and the value without separators alone, so equal values have equal
pseudonyms in all documents, and different values of one format have different ones. All of it is SQL expressions.

Defined results: a null text stays null with no finds; an empty text stays empty; overlapping candidates go to the one
that begins first, then to the first kind of the pattern; repeated rows get equal results; an empty table gives an
empty result; further columns stay only if asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])"
DAY_DATE = r"(?<![\w./-])\d{2}([./-])\d{2}\1\d{4}(?![\w/-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD = r"(?<![\w+])(?:\d{13,19}|\d{4}(?<four>[ -])\d{4}\k<four>\d{4}\k<four>\d{1,7}|\d{4}(?<six>[ -])\d{6}\k<six>\d{4,5})(?!\w)"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
ANY = "|".join((EMAIL, ISO_DATE, DAY_DATE.replace(r"([./-])", r"(?<sep>[./-])").replace(r"\1", r"\k<sep>"), IPV4, SSN, IBAN, CARD, PHONE))
MARK = "\ue000"  # stands around candidates while a text is cut
KINDS = ("email", "date", "ipv4", "ssn", "iban", "card", "phone")
ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73_049  # through 2099-12-31
RADIX = 271  # RADIX * RADIX >= DAYS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def shifted(symbols: Column, stream: Column) -> Column:
    """Each letter or digit moved on within its own alphabet by two hexadecimal digits of the stream."""

    def one(i: Column, known: Column) -> Column:
        c = F.substring(symbols, i, F.lit(1))
        k = F.conv(F.substring(known, (i * 2 - 1).cast("int"), F.lit(2)), 16, 10).cast("int")
        number = c.cast("string").rlike("^[0-9]$")
        return F.when(number, F.pmod(F.ascii(c) - 48 + k, F.lit(10)).cast("string")).otherwise(F.char(F.pmod(F.ascii(c) - 97 + k, F.lit(26)) + 97))

    return F.when(F.length(symbols) == 0, F.lit("")).otherwise(let(stream, lambda known: F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(symbols), F.lit(1))), lambda i: one(i, known)), "")))


def permuted(symbols: Column, kind: str, key: str) -> Column:
    """Keyed Feistel permutation of lower-case letters and digits, at most 128 of them."""
    half = F.floor(F.length(symbols) / 2).cast("int")
    start = F.struct(F.substring(symbols, F.lit(1), half).alias("l"), F.substring(symbols, half + 1, F.length(symbols)).alias("r"))
    stream = lambda i, other: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other), 512)

    def step(s: Column, i: Column) -> Column:
        left = i % 2 == 1
        return F.struct(F.when(left, shifted(s["l"], stream(i, s["r"]))).otherwise(s["l"]).alias("l"), F.when(left, s["r"]).otherwise(shifted(s["r"], stream(i, s["l"]))).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))


def permuted_pair(a: Column, b: Column, radix: int, kind: str, key: str) -> Column:
    """Keyed Feistel permutation of a pair of numbers below `radix`; struct(a, b)."""
    value = lambda i, other: F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")), 256), 1, 12), 16, 10).cast("long")
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        left = i % 2 == 1
        return F.struct(F.when(left, F.pmod(s["a"] + value(i, s["b"]), F.lit(radix))).otherwise(s["a"]).alias("a"), F.when(left, s["b"]).otherwise(F.pmod(s["b"] + value(i, s["a"]), F.lit(radix))).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def walked(start: Column, turn, good, most: int = 64) -> Column:
    """The permutation applied until its result is of the format again: a permutation of the format."""
    first = F.struct(turn(start).alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), first, lambda s, _: F.struct(F.when(good(s["v"]), s["v"]).otherwise(turn(s["v"])).alias("v")), lambda s: s["v"])


def filled(template: Column, symbols: Column, spot: str = "[0-9]") -> Column:
    """The template with its spots replaced by the symbols in order."""
    between = F.split(template, spot, -1)
    chars = let(symbols, lambda s: F.transform(F.sequence(F.lit(1), F.size(between)), lambda i: F.substring(s, i, F.lit(1))))
    return F.array_join(F.zip_with(between, chars, lambda a, b: F.concat(a, b)), "")


def luhn_sum(digits: Column, check_at_end: bool) -> Column:
    """The Luhn sum; without check digit, the last digit counts double."""
    n = F.length(digits)

    def one(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == (1 if check_at_end else 0)
        return total + F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), one)


def mod97(text: Column) -> Column:
    """The number that an IBAN's characters spell, moved as the standard says, modulo 97."""

    def one(r: Column, c: Column) -> Column:
        a = F.ascii(c)
        return F.when(a < 65, F.pmod(r * 10 + (a - 48), F.lit(97))).otherwise(F.pmod(r * 100 + (a - 55), F.lit(97)))

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), one)


def card(m: Column, key: str) -> tuple[Column, Column]:
    d = digits_of(m)
    check = lambda body: F.pmod(-luhn_sum(body, False), F.lit(10)).cast("string")
    new = let(permuted(F.substring(d, F.lit(1), F.length(d) - 1), "card", key), lambda body: F.concat(body, check(body)))
    return let(d, lambda x: F.pmod(luhn_sum(x, True), F.lit(10)) == 0), filled(m, new)


def phone(m: Column, key: str) -> tuple[Column, Column]:
    d = digits_of(m)
    code = F.when(~F.startswith(m, F.lit("+")), F.lit(0)).when(F.substring(d, 1, 1).isin("1", "7"), F.lit(1)).otherwise(F.lit(2))
    # Numbers of one country are linked with and without its code only where they are written alike.
    return F.length(d).between(7, 15), filled(m, F.concat(F.substring(d, F.lit(1), code), permuted(F.substring(d, code + 1, F.length(d)), "phone", key)))


def ssn(m: Column, key: str) -> tuple[Column, Column]:
    good = lambda d: ~F.substring(d, 1, 3).isin("000", "666") & (F.substring(d, 1, 1) != "9") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")
    return good(digits_of(m)), filled(m, walked(digits_of(m), lambda v: permuted(v, "ssn", key), good))


def ipv4(m: Column, key: str) -> tuple[Column, Column]:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    turned = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, "ipv4", key)
    parts = F.transform(F.array(turned), lambda t: F.concat_ws(".", F.floor(t["a"] / 256).cast("string"), (t["a"] % 256).cast("string"), F.floor(t["b"] / 256).cast("string"), (t["b"] % 256).cast("string")))
    return F.forall(o, lambda x: x <= 255), parts[0]


def iban(m: Column, key: str) -> tuple[Column, Column]:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    body = F.substring(plain, F.lit(5), F.length(plain))
    check = lambda new: F.lpad((98 - mod97(F.concat(new, F.substring(plain, 1, 2), F.lit("00")))).cast("string"), 2, "0")
    whole = let(F.upper(permuted(F.lower(body), "iban", key)), lambda new: F.concat(F.substring(plain, 1, 2), check(new), new))
    return mod97(F.concat(body, F.substring(plain, 1, 4))) == 1, filled(m, whole, "[A-Z0-9]")


def date(m: Column, key: str) -> tuple[Column, Column]:
    iso, day = m.rlike(r"^\d{4}-"), F.concat(F.substring(m, 7, 4), F.lit("-"), F.substring(m, 4, 2), F.lit("-"), F.substring(m, 1, 2))
    month = F.concat(F.substring(m, 7, 4), F.lit("-"), F.substring(m, 1, 2), F.lit("-"), F.substring(m, 4, 2))
    read = lambda x: F.try_to_date(x, "yyyy-MM-dd")
    value = F.when(iso, read(m)).otherwise(F.coalesce(read(day), read(month)))
    index = F.datediff(value, F.lit(FIRST_DAY).cast("date"))
    turn = lambda v: F.transform(F.array(permuted_pair(F.floor(v / RADIX), v % RADIX, RADIX, "date", key)), lambda t: t["a"] * RADIX + t["b"])[0]
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), walked(index.cast("long"), turn, lambda v: v < DAYS, 32).cast("int"))
    sep = F.substring(m, 3, 1)
    swapped = read(day).isNull()

    def written_as(x: Column) -> Column:
        dd, mm = F.date_format(x, "dd"), F.date_format(x, "MM")
        return F.when(iso, F.date_format(x, "yyyy-MM-dd")).otherwise(F.concat(F.when(swapped, mm).otherwise(dd), sep, F.when(swapped, dd).otherwise(mm), sep, F.date_format(x, "yyyy")))

    return index.between(0, DAYS - 1), let(new, written_as)


def email(m: Column, key: str) -> tuple[Column, Column]:
    low = F.lower(m)
    top = F.length(F.substring_index(low, ".", -1)) + 1
    head, tail = F.substring(low, F.lit(1), F.length(low) - top), F.substring(low, F.length(low) - top + 1, top)
    plain = F.regexp_replace(head, "[^a-z0-9]", "")
    return F.length(plain) <= 128, F.concat(filled(head, permuted(plain, "email", key), "[a-z0-9]"), tail)


MAKERS = {"email": email, "date": date, "ipv4": ipv4, "ssn": ssn, "iban": iban, "card": card, "phone": phone}


def kind_of(m: Column) -> Column:
    """The kind whose pattern the candidate matched: all of them are told apart by their shape."""
    return (
        F.when(F.instr(m, "@") > 0, "email").when(m.rlike(r"^\d{4}-\d{2}-\d{2}$") | m.rlike(r"^\d{2}([./-])\d{2}\1\d{4}$"), "date").when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ipv4")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban").when(~F.substring(m, 1, 1).isin("+", "(") & (F.length(digits_of(m)) >= 13), "card").otherwise("phone")
    )


def cut(text: Column) -> Column:
    """The text in parts, every second one a candidate. One pass marks the candidates; a text that has the mark itself takes two."""
    marked = F.split(F.regexp_replace(text, ANY, MARK + "$0" + MARK), MARK, -1)
    between, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    twice = F.filter(F.flatten(F.zip_with(between, found, lambda a, m: F.array(a, m))), lambda x: x.isNotNull())
    return F.when(F.contains(text, F.lit(MARK)), twice).otherwise(marked)


def pseudonym(m: Column, key: str) -> Column:
    """struct<value, kind, pseudonym> of a candidate; the pseudonym of an invalid one is null."""
    kind, result = kind_of(m), F.lit(None).cast("string")
    for name, make in MAKERS.items():
        good, new = make(m, key)
        result = F.when((kind == name), F.when(good, new)).otherwise(result)
    return F.struct(m.alias("value"), kind.alias("kind"), result.alias("pseudonym"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with (text, n_<kind>): the text with pseudonyms, and how many of each kind."""
    slim = docs.select(*keep, F.col(text_col).alias("__text"))
    null = F.lit(None).cast("string")
    parts = F.transform(cut(F.col("__text")), lambda p, i: F.when(i % 2 == 1, pseudonym(p, key)).otherwise(F.struct(p.alias("value"), null.alias("kind"), null.alias("pseudonym"))))
    rows = slim.withColumn("__parts", F.when(F.col("__text").rlike("[0-9@]"), parts))
    text = F.when(F.col("__parts").isNotNull(), F.array_join(F.transform("__parts", lambda p: F.coalesce(p["pseudonym"], p["value"])), "")).otherwise(F.col("__text"))

    def count(kind: str) -> Column:
        return F.when(F.col("__parts").isNull(), 0).otherwise(F.size(F.filter("__parts", lambda p: (p["kind"] == kind) & p["pseudonym"].isNotNull())))

    return rows.select(*keep, text.alias("text"), *(count(k).alias(f"n_{k}") for k in KINDS))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a key of its own, which keeps nothing secret; whoever hides real data passes one that nobody else has."""
    return pseudonymise(table(spark, sf_dir, "documents"), "op5")
