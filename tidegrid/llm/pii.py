"""Pseudonyms for personal data that keep its format: keyed Feistel permutations, in built-in functions only.

Numbers and dates are found by pattern and validated; what fails is left alone. A value is taken apart into two
numbers, which are mixed over ROUNDS rounds with a keyed hash of the other, each within its own range. So the result is
again a valid value of the same format, two values never get one pseudonym, and equal values get the same one in
every document. Who has the key can undo it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", (300, 250)  # the dates that are permuted among themselves, up to 2105
EDGE, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
KINDS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,20}[A-Za-z]{2,63}",
    "ip": EDGE + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}" + END,
    "ssn": EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END,
    "date": EDGE + r"(?:19|20|21)[0-9]{2}-[0-9]{2}-[0-9]{2}" + END,
    "secret": EDGE + r"(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})" + END,
    "card": EDGE + r"[0-9](?:[ -]?[0-9]){12,18}" + END,
}
ANY = "|".join(KINDS.values())


def feistel(a: Column, b: Column, range_a: Column, range_b: Column, key: str, tweak: Column) -> Column:
    """The struct ``a, b`` permuted among all pairs of numbers below the two ranges."""

    def mixed(of: Column, number: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, number.cast("string"), of.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")

    def one_round(pair: Column, number: Column) -> Column:
        odd = number % 2 == 1
        return F.struct(
            F.when(odd, (pair["a"] + mixed(pair["b"], number) % range_a) % range_a).otherwise(pair["a"]).alias("a"),
            F.when(odd, pair["b"]).otherwise((pair["b"] + mixed(pair["a"], number) % range_b) % range_b).alias("b"),
        )

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one_round)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Another string of as many digits, at most 18 and at least 2."""
    size = F.length(digits)
    left = F.floor(size / 2).cast("int")
    halves = [F.substr(digits, F.lit(1), left), F.substr(digits, left + 1, size - left)]
    tens = [F.pow(F.lit(10), n).cast("bigint") for n in (left, size - left)]
    pair = feistel(*halves, *tens, key, F.concat(F.lit(kind), size.cast("string")))
    return F.concat(F.lpad(pair["a"].cast("string"), left, "0"), F.lpad(pair["b"].cast("string"), size - left, "0"))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def in_format(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits``, one after the other."""
    start = F.struct(F.lit("").alias("done"), F.lit(1).alias("next"))

    def step(state: Column, letter: Column) -> Column:
        is_digit = letter.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["done"], F.when(is_digit, F.substr(digits, state["next"], F.lit(1))).otherwise(letter)).alias("done"),
            F.when(is_digit, state["next"] + 1).otherwise(state["next"]).alias("next"),
        )

    return F.aggregate(F.split(value, ""), start, step)["done"]


def luhn_sum(digits: Column) -> Column:
    """The sum whose last digit is 0 in a valid number."""

    def weight(digit: Column, place: Column) -> Column:
        n = digit.cast("int") * (place % 2 + 1)
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda a, b: a + b)


def card(value: Column, key: str) -> Column:
    """A number with a valid check digit: the others are permuted and the check digit is made anew."""
    digits = digits_of(value)
    others = permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - luhn_sum(F.concat(others, F.lit("0"))) % 10) % 10
    made = in_format(value, F.concat(others, check.cast("string")))
    return F.when(luhn_sum(digits) % 10 == 0, made).otherwise(value)


def date(value: Column, key: str) -> Column:
    day = F.datediff(value.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    a, b = DAYS
    pair = feistel(F.floor(day / b), day % b, F.lit(a), F.lit(b), key, F.lit("date"))
    made = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (pair["a"] * b + pair["b"]).cast("int")), "yyyy-MM-dd")
    return F.when((day >= 0) & (day < a * b), made).otherwise(value)


def ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    pair = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, F.lit("ip"))
    made = F.concat_ws(".", *[F.floor(pair[c] / 256).cast("string") if high else (pair[c] % 256).cast("string") for c in "ab" for high in (True, False)])
    return F.when(F.forall(octets, lambda x: x < 256), made).otherwise(value)


def phone(value: Column, key: str) -> Column:
    """The ten digits behind the country code are permuted, the country code stays.

    Numbers whose area code and exchange both begin with 2 to 9, as the North American plan has it, are permuted among
    themselves; those of other plans among all ten digits that are not of that kind.
    """
    digits = digits_of(value)
    code, ten = F.length(digits) - 10, F.substr(digits, F.length(digits) - 9, F.lit(10))
    area, exchange, line = (F.substr(ten, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (4, 3), (7, 4)))
    planned = (area >= 200) & (exchange >= 200)
    pair = feistel(area - 200, (exchange - 200) * 10_000 + line, F.lit(800), F.lit(8_000_000), key, F.lit("phone"))
    made = F.concat((pair["a"] + 200).cast("string"), (F.floor(pair["b"] / 10_000) + 200).cast("string"), F.lpad((pair["b"] % 10_000).cast("string"), 4, "0"))
    # Others: an area code below 200 with any exchange (200 x 1,000), then one from 200 on with an exchange below 200 (800 x 200).
    place = F.when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)
    other = feistel(place, line, F.lit(360_000), F.lit(10_000), key, F.lit("phone of another plan"))
    rest = other["a"] - 200_000
    front = F.when(rest < 0, other["a"]).otherwise((F.floor(rest / 200) + 200) * 1000 + rest % 200)
    made_other = F.concat(F.lpad(front.cast("string"), 6, "0"), F.lpad(other["b"].cast("string"), 4, "0"))
    return in_format(value, F.concat(F.substr(digits, F.lit(1), code), F.when(planned, made).otherwise(made_other)))


def secret(value: Column, key: str) -> Column:
    """Every eight hexadecimal digits are permuted, each block with its place."""

    def block(number: Column) -> Column:
        halves = [F.conv(F.substr(value, number * 8 + at, F.lit(4)), 16, 10).cast("bigint") for at in (1, 5)]
        pair = feistel(*halves, F.lit(65536), F.lit(65536), key, F.concat(F.lit("secret"), number.cast("string")))
        return F.concat(*[F.lpad(F.lower(F.hex(pair[c])), 4, "0") for c in "ab"])

    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(value) / 8).cast("int") - 1), block), "")


def email(value: Column, key: str) -> Column:
    """An address is no number: its pseudonym is a keyed hash, at a domain that is nobody's."""
    return F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, 16), F.lit("@example.org"))


def ssn(value: Column, key: str) -> Column:
    """Valid numbers (area 1 to 899 but 666, group and serial not 0) are permuted among themselves; others are left alone."""
    digits = digits_of(value)
    area, group, serial = (F.substr(digits, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (4, 2), (6, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = feistel(place, (group - 1) * 9_999 + serial - 1, F.lit(898), F.lit(99 * 9_999), key, F.lit("ssn"))
    made = (F.when(pair["a"] >= 665, pair["a"] + 2).otherwise(pair["a"] + 1), F.floor(pair["b"] / 9_999) + 1, pair["b"] % 9_999 + 1)
    return F.when(valid, in_format(value, F.concat(*[F.lpad(x.cast("string"), n, "0") for x, n in zip(made, (3, 2, 4))]))).otherwise(value)


def pseudonym(value: Column, key: str) -> Column:
    """What is written for a string that one of the patterns has matched."""
    makers = {"email": email, "ip": ip, "phone": phone, "ssn": ssn, "date": date, "secret": secret, "card": card}
    out = None
    for kind, pattern in KINDS.items():
        fits = value.rlike(f"^(?:{pattern})$")
        made = makers[kind](value, key)
        out = F.when(fits, made) if out is None else out.when(fits, made)
    return out.otherwise(value)


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_found, n_replaced, text`` for every row of ``docs``.

    ``n_found`` strings match a pattern, ``n_replaced`` of them are valid and got a pseudonym that differs. Patterns are tried from
    left to right over the whole text. A null text stays null with nothing found; rows that repeat get
    equal results. Other columns are ignored. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    none = F.array().cast("array<string>")
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(none)
    rows = rows.withColumn("found", found)
    rows = rows.withColumn("made", F.transform("found", lambda v: pseudonym(v, key)))
    parts = F.split("text", ANY, -1)
    # Text and pseudonyms by turns.
    pieces = F.transform(parts, lambda part, i: F.concat(part, F.coalesce(F.get("made", i), F.lit(""))))
    replaced = F.size(F.filter(F.arrays_zip("found", "made"), lambda x: x["found"] != x["made"]))
    return rows.select(
        "doc_id",
        F.size("found").cast("bigint").alias("n_found"),
        replaced.cast("bigint").alias("n_replaced"),
        F.when(F.size("found") > 0, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"),
    )
