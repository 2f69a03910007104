"""PII: format-preserving Feistel pseudonyms, with DataFrame functions only.

Found values are checked (Luhn, octets, calendar, length), then permuted by a keyed Feistel network
within their own format. The same value has the same pseudonym in every document, whatever its
punctuation, so linked records stay linked; without the key it can't be undone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: What is looked for. Every pattern begins where no value can have begun before.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}[.]){3}[0-9]{1,3}(?![0-9]|[.][0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = r"(?<![0-9+])(?:[+][0-9]{1,3}[ .-]?)?(?:[(][0-9]{2,4}[)][ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
LONG_PHONE = r"[+][0-9]{8,15}(?![0-9])"
SECRET = r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{16,64})(?![A-Za-z0-9])"
#: Numbers side by side; if the whole is no value, those within it are looked for (``pieces``).
RUN = r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){12,}+"
NUMBERS = "|".join((ADDRESS, DATE, SOCIAL, RUN, PHONE, LONG_PHONE))
#: Cards and phones as they are mostly written; they go before other readings of the same groups.
USUAL_CARD = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
USUAL_PHONE = r"^[0-9]{2,4}([ .-])[0-9]{3,4}\1[0-9]{3,4}$"
MOST_GROUPS = 19  #: a card has no more digits
ANY = f"{EMAIL}|{SECRET}|(?=[0-9+(])(?:{NUMBERS})"
#: A text without any of these has no value at all.
HINT = "[0-9@]|AKIA"

#: Days of the Gregorian cycle of 400 years, as the product of the two halves of a date's network.
CYCLE_DAYS, DATE_LEFT, DATE_RIGHT = 146_097, 189, 773
CYCLE_START = "1600-01-01"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digest(key: str, kind: str, round_: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), half.cast("string")).cast("binary"), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _network(left: Column, right: Column, n_left: Column, n_right: Column, key: str, kind: str) -> Column:
    """Struct (l, r): an alternating Feistel network on numbers below n_left and n_right."""

    def turn(state: Column, k: Column) -> Column:
        l, r = state["l"], state["r"]
        new_l = F.pmod(l + F.pmod(_number(_digest(key, kind, k, r)), n_left), n_left)
        new_r = F.pmod(r + F.pmod(_number(_digest(key, kind, k, l)), n_right), n_right)
        even = k % 2 == 0
        return F.struct(F.when(even, new_l).otherwise(l).alias("l"), F.when(even, r).otherwise(new_r).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the digit strings of each length (2 to 36), leading zeros included."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    rest = size - half
    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, rest)
    return _bound(
        _network(left, right, _power(half), _power(rest), key, kind),
        lambda s: F.concat(F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), rest, "0")),
    )


def luhn_digit(digits: Column) -> Column:
    """The digit that makes the string of digits and it pass the Luhn test."""

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(k % 2 == 0, folded).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10))


def _in_format(value: Column, digits: Column) -> Column:
    """The value with its digits replaced one by one."""

    def put(state: Column, k: Column) -> Column:
        char = F.substring(value, k, F.lit(1))
        is_digit = char.between("0", "9")
        taken = F.when(is_digit, F.substring(digits, state["n"] + 1, F.lit(1))).otherwise(char)
        return F.struct(
            (state["n"] + is_digit.cast("int")).alias("n"), F.concat(state["out"], taken).alias("out")
        )

    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, put)["out"]


def _shifted(text: Column, keyed_by: Column, key: str, kind: str, round_: Column, hex_digits: bool) -> Column:
    """Every letter and digit moved within its alphabet, by a stream from the other half."""

    def move(k: Column, stream: Column) -> Column:
        char = F.substring(text, k, F.lit(1))
        by = F.conv(F.substring(stream, F.pmod((k - 1) * 2, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(char)
        turned = lambda first, size: F.char(F.pmod(code - first + by, F.lit(size)) + first)
        if hex_digits:
            place = F.conv(char, 16, 10).cast("int")
            return F.lower(F.conv(F.pmod(place + by, F.lit(16)).cast("string"), 10, 16))
        return (
            F.when(char.between("0", "9"), turned(48, 10))
            .when(char.between("a", "z"), turned(97, 26))
            .when(char.between("A", "Z"), turned(65, 26))
            .otherwise(char)
        )

    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    moved = _bound(
        _digest(key, kind, round_, F.lower(keyed_by)),
        lambda stream: F.array_join(F.transform(places, lambda k: move(k, stream)), ""),
    )
    return F.when(F.length(text) == 0, "").otherwise(moved)


def permuted_text(text: Column, key: str, kind: str, hex_digits: bool = False) -> Column:
    """A permutation of strings that keeps the kind of every character."""
    size = F.length(text)
    half = F.floor(size / 2).cast("int")

    def turn(state: Column, k: Column) -> Column:
        l, r = state["l"], state["r"]
        even = k % 2 == 0
        return F.struct(
            F.when(even, _shifted(l, r, key, kind, k, hex_digits)).otherwise(l).alias("l"),
            F.when(even, r).otherwise(_shifted(r, l, key, kind, k, hex_digits)).alias("r"),
        )

    start = F.struct(
        F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, size).alias("r")
    )
    state = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _bound(state, lambda s: F.concat(s["l"], s["r"]))


def _digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _email(value: Column, key: str) -> Column:
    return F.concat(permuted_text(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1))


def _address(value: Column, key: str) -> Column:
    part = lambda k: F.split(value, "[.]")[k].cast("int")
    state = _network(part(0) * 256 + part(1), part(2) * 256 + part(3), F.lit(65536), F.lit(65536), key, "address")

    def written(s: Column) -> Column:
        octets = [F.shiftright(s["l"], 8), s["l"] % 256, F.shiftright(s["r"], 8), s["r"] % 256]
        return F.concat_ws(".", *[o.cast("string") for o in octets])

    return _bound(state, written)


def _iso(value: Column) -> Column:
    """The date as yyyy-MM-dd; of two-digit fields the first is the day."""
    turned = F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2))
    return F.when(F.substring(value, 5, 1) == "-", value).otherwise(turned)


def _date(value: Column, key: str) -> Column:
    """Another day of the same 400 years, written alike; the halves' product is the cycle exactly."""
    days = F.datediff(F.try_to_date(_iso(value), "yyyy-MM-dd"), F.lit(CYCLE_START).cast("date"))
    day = days % CYCLE_DAYS
    left, right = F.floor(day / DATE_RIGHT), day % DATE_RIGHT
    state = _network(left, right, F.lit(DATE_LEFT), F.lit(DATE_RIGHT), key, "date")
    moved = _bound(state, lambda s: (s["l"] * DATE_RIGHT + s["r"] + days - day).cast("int"))

    def written(iso: Column) -> Column:
        mark = F.substring(value, 3, 1)
        turned = F.concat(F.substring(iso, 9, 2), mark, F.substring(iso, 6, 2), mark, F.substring(iso, 1, 4))
        return F.when(F.substring(value, 5, 1) == "-", iso).otherwise(turned)

    return _bound(F.date_format(F.date_add(F.lit(CYCLE_START).cast("date"), moved), "yyyy-MM-dd"), written)


def _card(value: Column, key: str) -> Column:
    digits = _digits_of(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = _bound(body, lambda b: F.concat(b, luhn_digit(b).cast("string")))
    return _bound(whole, lambda w: _in_format(value, w))


def _phone(value: Column, key: str, kind: str = "phone") -> Column:
    """The last ten digits (all, if fewer) are permuted; a country code stays."""
    digits = _digits_of(value)
    size = F.least(F.length(digits), F.lit(10))
    head = F.substring(digits, F.lit(1), F.length(digits) - size)
    moved = F.concat(head, permuted_digits(F.right(digits, size), key, kind))
    return _bound(moved, lambda w: _in_format(value, w))


def _secret(value: Column, key: str) -> Column:
    marked = F.concat(F.substring(value, 1, 4), permuted_text(F.substring(value, 5, 16), key, "secret"))
    return F.when(value.startswith("AKIA"), marked).otherwise(permuted_text(value, key, "hex", hex_digits=True))


def _is_card(value: Column) -> Column:
    digits = _digits_of(value)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    last = _bound(body, lambda b: luhn_digit(b).cast("string"))
    right = F.length(digits).between(13, 19) & (F.right(digits, F.lit(1)) == last)
    return right & ~digits.rlike("^(.)\\1*$")


def _is_address(value: Column) -> Column:
    return F.forall(F.split(value, "[.]"), lambda part: part.cast("int") <= 255)


def _is_social(value: Column) -> Column:
    return ~F.substring(value, 1, 3).isin("000", "666") & (F.substring(value, 1, 1) != "9")


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def kind_of(value: Column) -> Column:
    """Kind of a found value; null if it does not pass the test of its kind."""
    date = F.try_to_date(_iso(value), "yyyy-MM-dd")
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(_whole(ADDRESS)), F.when(_is_address(value), "address"))
        .when(value.rlike(_whole(DATE)), F.when(date.isNotNull() & (F.year(date) >= 1600), "date"))
        .when(value.rlike(_whole(SOCIAL)), F.when(_is_social(value), "social"))
        .when(value.rlike(_whole(SECRET)) & value.rlike("[A-Za-z]"), "secret")
        .when(value.rlike(_whole(CARD)) & _is_card(value), "card")
        .when(value.rlike(_whole(f"{PHONE}|{LONG_PHONE}")), F.when(F.length(_digits_of(value)).between(7, 15), "phone"))
    )


def pieces(value: Column) -> Column:
    """A found value as itself, or a run of numbers that is none cut into the values within it and the rest.

    Values begin and end with whole groups of digits, so all sequences of groups are tried. Of those that
    overlap the usual form goes first, then the earlier, then the longer.
    """

    def rank(it: Column) -> Column:
        text = it["text"]
        alone = it["before"].isin("", " ") & it["after"].isin("", " ")
        return _bound(
            kind_of(text),
            lambda kind: F.when((kind == "card") & text.rlike(USUAL_CARD), 0)
            .when(kind.isin("date", "social", "address"), F.when(alone, 1))
            .when((kind == "phone") & text.rlike(USUAL_PHONE), 2)
            .when(kind == "card", 3)
            .when(kind == "phone", 4),
        )

    def cut(tokens: Column) -> Column:
        groups = ((F.size(tokens) + 1) / 2).cast("int")
        part = lambda first, n: F.array_join(F.slice(tokens, first, n), "")

        def sequences(i: Column) -> Column:
            def one(k: Column) -> Column:
                return F.struct(
                    i.alias("i"),
                    k.alias("k"),
                    part(2 * i + 1, 2 * k - 1).alias("text"),
                    F.coalesce(F.get(tokens, 2 * i - 1), F.lit("")).alias("before"),
                    F.coalesce(F.get(tokens, 2 * (i + k) - 1), F.lit("")).alias("after"),
                )

            return F.transform(F.sequence(F.lit(1), F.least(F.lit(MOST_GROUPS), groups - i)), one)

        every = F.flatten(F.transform(F.sequence(F.lit(0), groups - 1), sequences))
        sized = F.filter(every, lambda it: F.length(it["text"]).between(7, 2 * MOST_GROUPS - 1))
        ranked = F.transform(
            sized, lambda it: F.struct(rank(it).alias("rank"), it["i"].alias("i"), (-it["k"]).alias("less"))
        )
        ranked = F.array_sort(F.filter(ranked, lambda it: it["rank"].isNotNull()))

        def choose(state: Column, it: Column) -> Column:
            free = ~F.exists(state, lambda c: (c["i"] < it["i"] - it["less"]) & (it["i"] < c["i"] - c["less"]))
            return F.when(free, F.concat(state, F.array(F.struct(it["i"].alias("i"), it["less"].alias("less"))))).otherwise(state)

        chosen = F.array_sort(F.aggregate(ranked, F.array().cast("array<struct<i:int,less:int>>"), choose))

        def add(state: Column, c: Column) -> Column:
            first, n = 2 * c["i"] + 1, -2 * c["less"] - 1
            gap = part(state["next"], first - state["next"])
            return F.struct((first + n).alias("next"), F.concat(state["out"], F.array(gap, part(first, n))).alias("out"))

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("out"))
        end = lambda state: F.concat(state["out"], F.array(part(state["next"], F.size(tokens) + 1 - state["next"])))
        return F.aggregate(chosen, start, add, end)

    tokens = F.regexp_extract_all(value, F.lit("[0-9]+|[^0-9]"), F.lit(0))
    mixed = value.rlike(_whole(RUN)) & value.rlike("[^0-9]")
    whole = F.array(value)
    return F.when(mixed, F.when(kind_of(value).isNull(), _bound(tokens, cut)).otherwise(whole)).otherwise(whole)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; a value that fails its test stays."""
    made: dict[str, Callable[[Column, str], Column]] = {
        "email": _email, "address": _address, "date": _date, "card": _card, "phone": _phone, "secret": _secret,
        "social": lambda v, k: _phone(v, k, "social"),
    }

    def chosen(kind: Column) -> Column:
        result = value
        for name, function in made.items():
            result = F.when(kind == name, function(value, key)).otherwise(result)
        return result

    return _bound(kind_of(value), chosen)


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The input's rows with all values replaced, and their number in ``n_values`` (an input column of
    that name is replaced).

    A null text stays null, a text without values is unchanged. Whole texts are searched, with one
    pattern, so values never overlap.
    """
    body = F.col(f"`{text}`")
    values = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    found = docs.withColumn("n_values", F.lit(0).cast("long")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "n_values"],
        F.when(body.rlike(HINT), values).otherwise(F.array().cast("array<string>")).alias("n_values"),
    )
    texts = F.split(body, ANY, -1)
    made = F.transform("n_values", lambda v: F.array_join(F.transform(pieces(v), lambda p: pseudonym(p, key)), ""))
    joined = F.zip_with(texts, made, lambda piece, name: F.concat(piece, F.coalesce(name, F.lit(""))))
    clean = F.when(F.size("n_values") == 0, body).otherwise(F.array_join(joined, ""))
    count = F.size(F.filter(F.flatten(F.transform("n_values", pieces)), lambda v: kind_of(v).isNotNull())).cast("long")
    return found.select(
        *[(clean if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns if c != "n_values"],
        count.alias("n_values"),
    )
