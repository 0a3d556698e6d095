"""Format-preserving pseudonyms for personal numbers and dates, in built-in functions only.

A validated value is read as a number in its own domain, permuted by a keyed Feistel network over that domain and
written back in the same format: digits to digits with the separators left in place, dates to dates, addresses to
addresses, and card numbers to numbers whose check digit is right. A permutation keeps equal values equal and
different ones different, in every document, without a table of what was seen. Values that fail validation stay.

A form can match from every place of a text, so what an invalid match took is looked at again. Of a card or account
number that fails as a whole, the shorter readings that end at a separator are tried.

A network works on (x, y) in Z_a x Z_b: rounds add a keyed SHA-256 of one half to the other in turn, which is a
bijection for any a and b, so no value needs a second walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeveil.llm.common import landed, located

_ROUNDS = 10
_ERA_DAYS = 65536
# The forms that are looked for, tried in this order at each place.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "iso_date": r"(?<![A-Za-z0-9/.-])\d{4}-\d{2}-\d{2}(?![0-9-])",
    "slash_date": r"(?<![A-Za-z0-9/.-])\d{2}/\d{2}/\d{4}(?![0-9/])",
    "dot_date": r"(?<![A-Za-z0-9/.-])\d{2}\.\d{2}\.\d{4}(?![0-9]|\.[0-9])",
    "ip": r"(?<![A-Za-z0-9]|[0-9]\.)\d{1,3}(?:\.\d{1,3}){3}(?![0-9]|\.[0-9])",
    "us_phone": r"(?<![A-Za-z0-9])(?:\+1[\x20.-]?)?(?:\(\d{3}\)[\x20.-]?|\d{3}[\x20.-])\d{3}[\x20.-]\d{4}(?![0-9])",
    "ssn": r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "card": r"(?<![A-Za-z0-9])\d(?:[\x20-]?\d){12,18}(?![0-9])",
    "phone": r"(?<![A-Za-z0-9])\+\d{1,3}(?:[\x20.-]?\(?\d{2,4}\)?){2,4}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in FORMS.values())
# Lengths that issuers of cards use with their prefixes; shorter readings of these are tried first.
_ISSUED = (
    r"^(?:4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}"
    r"|3(?:0[0-5]|[68]\d)\d{11}|35\d{14,17}|6\d{15,18}|220[0-4]\d{12,15})$"
)
# Days after the twelfth are found within so many steps, but for some 1 in 10^16.
_WALKS = 40
# Matches that are put together at a time.
_RUN = 512


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A struct (x, y), the keyed permutation of (x, y) in Z_a x Z_b."""

    def noise(half: Column, r: Column) -> Column:
        hashed = F.sha2(F.concat_ws("|", F.lit(key), tweak, r, half), 256)
        return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long")

    def step(acc: Column, r: Column) -> Column:
        left = F.when(r % 2 == 0, (acc["x"] + F.pmod(noise(acc["y"], r), a)) % a).otherwise(acc["x"])
        right = F.when(r % 2 == 1, (acc["y"] + F.pmod(noise(acc["x"], r), b)) % b).otherwise(acc["y"])
        return F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), start, step)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1), "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of the same length (2 to 36 digits)."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    rest = (size - half).cast("int")
    moved = feistel(
        F.substring(digits, 1, half), F.substring(digits, half + 1, rest), _power(half), _power(rest),
        key, F.concat_ws(":", F.lit(kind), size),
    )
    return F.concat(F.lpad(moved["x"].cast("string"), half, "0"), F.lpad(moved["y"].cast("string"), rest, "0"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""
    between = F.split(value, r"\d", -1)
    each = F.concat(F.split(digits, ""), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, each, lambda b, d: F.concat(F.coalesce(b, F.lit("")), F.coalesce(d, F.lit("")))), "")


def luhn_sum(digits: Column) -> Column:
    """The checksum of a number with its check digit; a right one is 0 mod 10."""

    def term(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, twice).otherwise(n)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda a, v: a + v)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    return F.when(luhn_sum(digits) % 10 == 0, refilled(value, F.concat(body, check.cast("string"))))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    # The country's code stays: what follows it is permuted.
    kept = F.when(value.startswith("+1"), 1).when(value.startswith("+"), 2).otherwise(0)
    rest = F.substring(digits, kept + 1, F.length(digits))
    good = (F.length(digits) >= 8) & (F.length(digits) <= 15)
    return F.when(good, refilled(value, F.concat(F.substring(digits, F.lit(1), kept), permuted_digits(rest, key, "phone"))))


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001: permuted among these."""
    area, group, serial = (F.substring(value, *at).cast("long") for at in ((1, 3), (5, 2), (8, 4)))
    good = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    moved = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"))
    new_place = F.floor(moved["x"] / 99)
    parts = (
        (new_place + F.when(new_place >= 665, 2).otherwise(1), 3), (moved["x"] % 99 + 1, 2), (moved["y"] + 1, 4)
    )
    return F.when(good, F.concat_ws("-", *[F.lpad(n.cast("string"), size, "0") for n, size in parts]))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    moved = feistel(
        octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, F.lit("ip")
    )
    new = F.concat_ws(".", *[F.floor(moved[h] / 256) if k == 0 else moved[h] % 256 for h in "xy" for k in (0, 1)])
    return F.when(F.array_max(octets) <= 255, new)


def _moved_day(number: Column, key: str) -> Column:
    era = F.floor(number / F.lit(_ERA_DAYS))
    within = number - era * _ERA_DAYS
    moved = feistel(F.floor(within / 256), within % 256, F.lit(256), F.lit(256), key, F.concat_ws(":", F.lit("date"), era))
    return (era * _ERA_DAYS + moved["x"] * 256 + moved["y"]).cast("int")


def _date(value: Column, key: str, form: str, late: bool = False) -> Column:
    """Days since 1900 are permuted within their era of 65,536 days (some 179 years). With ``late``, only days after the
    twelfth of a month count, and are permuted among themselves: steps are repeated until they lead to such a day."""
    first = F.lit("1900-01-01").cast("date")
    day = F.try_to_timestamp(value, F.lit(form)).cast("date")
    number = F.datediff(day, first)

    def walk(at: Column, i: Column) -> Column:
        return F.when((i == 1) | (F.dayofmonth(F.date_add(first, at)) <= 12), _moved_day(at, key)).otherwise(at)

    moved = F.aggregate(F.sequence(F.lit(1), F.lit(_WALKS)), number, walk) if late else _moved_day(number, key)
    new = F.date_format(F.date_add(first, moved), form)
    return F.when(F.dayofmonth(day) > 12, new) if late else new


def _iban_rest(value: Column) -> Column:
    """The number mod 97, letters standing for 10 to 35; a right one leaves 1."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    codes = F.transform(
        F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    )
    return F.aggregate(codes, F.lit(0), lambda a, c: F.when(c > 9, a * 100 + c).otherwise(a * 10 + c) % 97)


def _iban(value: Column, key: str) -> Column:
    """Country and letters stay, the digits after the check digits are permuted, and the check digits are made right."""
    digits = F.substring(_digits(value), F.lit(3), F.length(value))
    body = permuted_digits(digits, key, "iban")
    blank = refilled(value, F.concat(F.lit("00"), body))
    check = F.lpad((98 - _iban_rest(blank)).cast("string"), 2, "0")
    good = (F.length(digits) >= 4) & (_iban_rest(F.when(value.rlike("^[A-Z]{2}[0-9]{2}"), value)) == 1)
    return F.when(good, F.concat(F.substring(value, 1, 2), check, F.substring(blank, F.lit(5), F.length(blank))))


def _email(value: Column, key: str) -> Column:
    """No number: a keyed digest of the address, at a domain that cannot exist."""
    return F.concat(F.lit("p"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lower(value)), 256), 1, 16), F.lit("@mail.invalid"))


def pseudonym(value: Column, key: str) -> Column:
    """(kind, new) of a match of ``ANY``; null for a value that isn't valid."""
    forms = {
        "email": _email(value, key),
        "iban": _iban(value, key),
        "iso_date": _date(value, key, "yyyy-MM-dd"),
        # What can't be dd/MM is MM/dd, and stays so.
        "slash_date": F.coalesce(_date(value, key, "dd/MM/yyyy"), _date(value, key, "MM/dd/yyyy", late=True)),
        "dot_date": _date(value, key, "dd.MM.yyyy"),
        "ip": _ip(value, key),
        "us_phone": _phone(value, key),
        "ssn": _ssn(value, key),
        "card": _card(value, key),
        "phone": _phone(value, key),
    }
    # A match stands alone here, so each form's look-around is met and the first that fits is the one that matched.
    chosen = F.lit(None).cast("struct<kind:string,new:string>")
    for kind, new in reversed(forms.items()):
        made = F.when(new.isNotNull(), F.struct(F.lit(kind).alias("kind"), new.alias("new")))
        chosen = F.when(value.rlike(f"^(?:{FORMS[kind]})$"), made).otherwise(chosen)
    return chosen


def _readings(value: Column) -> Column:
    """A match and, of numbers in groups, what is left of it if groups are taken off its end."""
    groups = F.split(value, r"(?=[\x20-])", -1)
    numbers = F.sequence(F.size(groups) - 1, F.lit(1), F.lit(-1))
    shorter = F.transform(numbers, lambda n: F.array_join(F.slice(groups, F.lit(1), n), ""))
    shorter = F.filter(shorter, lambda r: r.rlike(f"^(?:{FORMS['card']}|{FORMS['iban']})$"))

    def issued(r: Column) -> Column:
        return _digits(r).rlike(_ISSUED)

    some = F.concat(F.array(value), F.filter(shorter, issued), F.filter(shorter, lambda r: ~issued(r)))
    grouped = value.rlike(f"^(?:{FORMS['card']}|{FORMS['iban']})$") & (F.size(groups) > 1)
    return F.when(grouped, some).otherwise(F.array(value))


def _made(value: Column, key: str) -> Column:
    """(kind, new, used) of the first valid reading of a match, ``used`` its length; null if none is valid."""

    def step(acc: Column, r: Column) -> Column:
        made = F.transform(F.array(pseudonym(r, key)), lambda p: F.when(p.isNotNull(), F.struct(p["kind"], p["new"], F.length(r).alias("used"))))
        return F.when(acc.isNull(), made[0]).otherwise(acc)

    return F.aggregate(_readings(value), F.lit(None).cast("struct<kind:string,new:string,used:int>"), step)


def _replaced(pieces: Column, made: Column) -> Column:
    """(text, kind) pieces: from left to right, each valid reading is replaced that doesn't start within the one before.

    ``pieces`` are cut where matches start, ``made`` has what was made of each match."""

    def step(acc: Column, item: Column) -> Column:
        size, free = F.length(item["piece"]), acc["skip"] == 0
        taken = free & item["made"].isNotNull()
        used = F.when(taken, item["made"]["used"]).otherwise(acc["skip"])
        rest = F.substring(item["piece"], used + 1, size)
        new = F.when(taken, F.concat(item["made"]["new"], rest)).otherwise(rest)
        kind = F.when(taken, item["made"]["kind"])
        return F.struct(
            F.greatest(used - size, F.lit(0)).alias("skip"),
            F.concat(acc["out"], F.array(F.struct(new.alias("text"), kind.alias("kind")))).alias("out"),
        )

    # Run by run: adding to the end of one list of all pieces would take the square of their number.
    items = F.arrays_zip(pieces.alias("piece"), made.alias("made"))
    starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(_RUN))
    runs = F.transform(starts, lambda at: F.slice(items, at, F.lit(_RUN)))
    kind = "array<struct<text:string,kind:string>>"

    def run(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(acc["skip"].alias("skip"), F.array().cast(kind).alias("out")), step)
        joined = lambda r: F.struct(r["skip"].alias("skip"), F.concat(acc["out"], F.array(r["out"])).alias("out"))
        return F.transform(F.array(inner), joined)[0]

    start = F.struct(F.lit(0).alias("skip"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(runs, start, run, lambda acc: F.flatten(acc["out"]))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """(locator, doc_id, text, n_values, kinds), one row per row of ``docs``: whole texts with pseudonyms in place.

    ``kinds`` lists the kinds replaced, in order of place. A null text stays null, with no values; an empty text
    stays empty. Repeated rows give repeated results, an empty table none. Only doc_id and text are read.
    """
    rows = located(landed(docs), "doc_id", "text")
    some = F.regexp_like("text", F.lit(ANY))
    # Matches from every place, overlapping ones too. The line break before a text keeps its first piece apart.
    led = F.concat(F.lit("\n"), "text")
    made = F.transform(F.regexp_extract_all(led, F.lit(f"(?=({ANY}))"), F.lit(1)), lambda v: _made(v, key))
    rows = rows.withColumns({"lv_some": some, "lv_pieces": F.when(some, F.split(led, f"(?={ANY})", -1)), "lv_made": F.when(some, made)})
    rest = F.slice("lv_pieces", F.lit(2), F.size("lv_pieces") - 1)
    rows = rows.withColumn("lv_out", F.when(F.col("lv_some"), _replaced(rest, F.col("lv_made"))))
    joined = F.concat(F.expr("substring(lv_pieces[0], 2)"), F.array_join(F.transform("lv_out", lambda p: p["text"]), ""))
    kinds = F.filter(F.transform("lv_out", lambda p: p["kind"]), lambda k: k.isNotNull())
    kinds = F.coalesce(kinds, F.array().cast("array<string>"))
    return rows.select(
        "lv_file",
        "lv_pos",
        "doc_id",
        F.when(F.col("lv_some"), joined).otherwise(F.col("text")).alias("text"),
        F.size(kinds).cast("long").alias("n_values"),
        F.array_join(kinds, ",").alias("kinds"),
    )
