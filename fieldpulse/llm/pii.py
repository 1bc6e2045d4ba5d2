"""Personal data: format-preserving Feistel pseudonyms.

Found in texts: card numbers (Luhn), IBANs (mod 97), US social security numbers (assigned
ranges), phone numbers, IPv4 addresses, dates (of the calendar, in four formats), e-mail
addresses and long hexadecimal secrets. Numbers and dates count only if they are valid.
Cards and IBANs are checked at every length that ends between groups, so a number or word
beside one neither hides nor changes it; of several valid spans the one in an issuer's usual
layout, or of its country's length, is taken. A date with slashes has the month first where
that is a day of the calendar, else the day.
Each value is permuted by a keyed Feistel network within its format: a card becomes a
valid card, a date a date of the same 400 years, an IBAN an IBAN of its country, and
separators stay where they are. A permutation has no collisions, and the key alone decides,
so equal values are equal pseudonyms in every document and different ones stay different, but
for two kinds of text: hexadecimal secrets that differ in the case of letters only, and of both
cases, become one; so do e-mail addresses of equal shape in the letters of scripts beyond Latin,
which are written as ``x``.

Two networks. Numbers with a range that is a product of two sizes are split in two residues
that are added to alternately, so no value has to be drawn twice. Strings are cut in two
halves whose characters are shifted alternately, each within its own class (digits, letters
of either case, hexadecimal letters); other characters stay.

The round function is SHA-256 of key, kind, round and the other half. Twelve rounds. The key
is a parameter and stands in the query plan; give it from a secret store and keep plans of
such jobs private. E-mail domains stay, so that mail of one provider remains countable.

Defined cases: null texts stay null and count nothing; empty texts stay empty; a value that
occurs more than once is replaced each time; invalid numbers and dates stay as they are; an
empty table stays empty. ``n_chars``, where present, is that of the new text, which has the
length of the old one but for IPv4 addresses. Other columns pass through and may have any name.

Only DataFrame functions are used. Nothing is shuffled: values are linked by the key, not by
a join. Texts without a digit or an at sign are not searched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.llm.common import fresh_name

ROUNDS = 12
#: Hex digits of the round function that make one number, and of one character's shift.
NUMBER_DIGITS = 15
SHIFT_DIGITS = 4

# What the formats look like. Every pattern starts at a word's edge.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
SECRET = r"(?<![\p{L}\p{N}])[0-9a-fA-F]{32,}+(?![\p{L}\p{N}])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
IPV4 = r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[\p{L}\p{N}])"
ISO_DATE = r"(?<![\p{L}\p{N}-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!-?[\p{L}\p{N}])"
DOT_DATE = r"(?<![\p{L}\p{N}.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?!\.?[\p{L}\p{N}])"
SLASH_DATE = r"(?<![\p{L}\p{N}/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?!/?[\p{L}\p{N}])"
SSN = r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[\p{L}\p{N}])"
CARD = r"(?<![\p{L}\p{N}+.-])[0-9](?:[ -]?[0-9]){12,18}(?!-?[\p{L}\p{N}])"
PHONE = r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+])\+[0-9](?:[ .-]?[0-9]){7,14}(?![\p{L}\p{N}])"

# issuers' prefixes and layouts, lengths of IBANs.
USUAL_CARD = r"^(?=4|5[0-8]|6|3|22[2-9]|2[3-6]|27[01]|2720)(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
USUAL_IBAN = "^(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}[A-Z0-9]{{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + ")$"
# Shaped like an IBAN of its country or a card of 14 digits, but not valid: its parts are not searched.
LIKE_IBAN = r"(?<![\p{L}\p{N}])(?:" + "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in IBAN_LENGTHS.items()
) + r")(?![\p{L}\p{N}])"
LIKE_CARD = r"(?<![\p{L}\p{N}+.-])[0-9]{4}[ -][0-9]{6}[ -][0-9]{4}(?![ -]?[\p{L}\p{N}])"
# Where a card may begin and end beside other digits, and the longest one from each beginning.
CARD_START, CARD_END = r"(?:(?<![\p{L}\p{N}+.-])|(?<=[0-9]-))", r"(?![\p{L}\p{N}]|-\p{L})"
CARDS_FROM = CARD_START + r"(?=([0-9](?:[ -]?[0-9]){12,18}" + CARD_END + "))"
IBANS_FROM = r"(?<![\p{L}\p{N}])(?=(" + IBAN + "))"
IBAN_END = r"(?![\p{L}\p{N}])"


def _any(ibans: str = "", cards: str = "", inside: str = "") -> str:
    """What is searched, with alternatives for a text's valid IBANs and cards; ``inside`` is tested between a phone number's groups."""
    phone = PHONE.replace(r"\)?[ .-]?", rf"\)?{inside}[ .-]?", 1).replace("[0-9]{3}[ .-]?[0-9]{4}", rf"[0-9]{{3}}{inside}[ .-]?[0-9]{{4}}", 1)
    kinds = (EMAIL, SECRET, ibans, LIKE_IBAN, IPV4, ISO_DATE, DOT_DATE, SLASH_DATE, SSN, cards, LIKE_CARD, phone)
    return "|".join(kind for kind in kinds if kind)


ANY = _any()

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LATIN_LOWER, LATIN_UPPER = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
HEX_LOWER, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"
#: First day and days of 400 years, the calendar's period; 146097 = 189 * 773.
FIRST_DAY, DAY_SIZES = "1800-01-01", (189, 773)
#: Area, group and serial numbers that are assigned: 898 * (99 * 9999).
SSN_SIZES = (898, 99 * 9999)


# --- Small expressions ----------------------------------------------------------------


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _at(text: Column, i: Column) -> Column:
    """Character ``i``, from 1."""
    return F.substring(text, i, F.lit(1))


def _over(n: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step(state, i)`` for i from 1 to ``n``; ``start`` where n is 0."""
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)).otherwise(start)


def _refill(value: Column, characters: Column, kind: str) -> Column:
    """``value`` with its characters of the class ``kind`` replaced by ``characters`` in order."""

    def fill(new: Column) -> Column:
        # One character more at a time, from as many of the class as stand before it.
        place = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i), f"[^{kind}]", ""))
        put = lambda i: F.when(_at(value, i).rlike(f"[{kind}]"), _at(new, place(i))).otherwise(_at(value, i))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), put), "")

    return _let(characters, fill)


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, each second one from the right doubled and its digits added."""

    def total(back: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            d = _at(back, i).cast("int")
            return acc + F.when(i % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

        return _over(F.length(back), F.lit(0), step)

    return _let(F.reverse(digits), total)


def mod97(text: Column) -> Column:
    """Remainder of an IBAN's characters, letters as two-digit numbers, read as one number."""

    def remainder(whole: Column) -> Column:
        def step(rest: Column, i: Column) -> Column:
            return _let(F.ascii(_at(whole, i)), lambda code: F.when(
                code >= 65, (rest * 100 + code - 55) % 97
            ).otherwise((rest * 10 + code - 48) % 97))

        return _over(F.length(whole), F.lit(0), step)

    return _let(text, remainder)


# --- Networks -------------------------------------------------------------------------


def _hash(key: str, kind: str, number: Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(f"{key}|{kind}"), number.cast("string"), *parts).cast("binary"), 256)


def permuted_number(value: Column, sizes: tuple[int, int] | tuple[Column, Column], key: str, kind: str) -> Column:
    """Image of ``value``, 0 to the product of ``sizes``, under a keyed permutation of that range."""
    a, b = (F.lit(s).cast("long") if isinstance(s, int) else s for s in sizes)
    value = value.cast("long")

    def step(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, state["right"]).otherwise(state["left"])
        digest = _hash(key, kind, i, other.cast("string"))
        plus = F.conv(F.substring(digest, 1, NUMBER_DIGITS), 16, 10).cast("long")
        return F.struct(
            F.when(even, (state["left"] + plus) % a).otherwise(state["left"]).alias("left"),
            F.when(even, state["right"]).otherwise((state["right"] + plus) % b).alias("right"),
        )

    start = F.struct(F.floor(value / b).cast("long").alias("left"), (value % b).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda end: end["left"] * b + end["right"])


def _shifted(half: Column, digest: Column, alphabets: list[str]) -> Column:
    """``half`` with every character moved within its alphabet by a part of ``digest``."""

    def move(c: Column, i: Column) -> Column:
        at = (i * SHIFT_DIGITS) % (F.length(digest) - SHIFT_DIGITS + 1) + 1
        plus = F.conv(F.substring(digest, at, F.lit(SHIFT_DIGITS)), 16, 10).cast("int")
        moved = c
        for alphabet in alphabets:
            place = F.instr(F.lit(alphabet), c)
            moved = F.when(place > 0, _at(F.lit(alphabet), (place - 1 + plus) % len(alphabet) + 1)).otherwise(moved)
        return moved

    characters = F.filter(F.split(half, ""), lambda c: c != "")
    return F.array_join(F.transform(characters, move), "")


def permuted_string(value: Column, alphabets: list[str], key: str, kind: str) -> Column:
    """Image of ``value`` under a keyed permutation of the strings of its shape."""

    def step(state: Column, i: Column) -> Column:
        # The halves change places each round: the first one is moved by the second.
        digest = F.concat(*[_hash(key, kind, i, F.lit(part), state["other"]) for part in "01"])
        moved = _let(digest, lambda d: _shifted(state["half"], d, alphabets))
        return F.struct(state["other"].alias("half"), moved.alias("other"))

    def network(whole: Column) -> Column:
        size = F.floor(F.length(whole) / 2).cast("int")
        start = F.struct(
            F.substring(whole, size + 1, F.length(whole)).alias("half"),
            F.substring(whole, F.lit(1), size).alias("other"),
        )
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda end: F.concat(end["other"], end["half"])
        )

    return _let(value, network)


# --- Kinds of values ------------------------------------------------------------------


def _card(value: Column, key: str) -> Column:
    """The first digit, the network's, stays; the check digit is made anew."""

    def checked(body: Column) -> Column:
        check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
        return F.concat(body, check.cast("string"))

    def permute(digits: Column) -> Column:
        rest = permuted_string(F.substring(digits, F.lit(2), F.length(digits) - 2), [DIGITS], key, "card")
        whole = _let(F.concat(F.substring(digits, 1, 1), rest), checked)
        return F.when(luhn_sum(digits) % 10 == 0, _refill(value, whole, "0-9")).otherwise(value)

    return _let(_digits(value), permute)


def _iban(value: Column, key: str) -> Column:
    """The country stays; the account is permuted within its shape and checked anew."""

    def permute(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))

        def checked(moved: Column) -> Column:
            check = 98 - mod97(F.concat(moved, country, F.lit("00")))
            return F.concat(country, F.lpad(check.cast("string"), 2, "0"), moved)

        whole = _let(permuted_string(account, [DIGITS, UPPER], key, "iban"), checked)
        valid = mod97(F.concat(account, F.substring(plain, 1, 4))) == 1
        return F.when(valid, _refill(value, whole, "A-Z0-9")).otherwise(value)

    return _let(F.regexp_replace(value, " ", ""), permute)


def _ssn(value: Column, key: str) -> Column:
    def present(moved: Column) -> Column:
        high, low = F.floor(moved / SSN_SIZES[1]) + 1, moved % SSN_SIZES[1]
        return F.format_string(
            "%03d-%02d-%04d", high + F.when(high > 665, 1).otherwise(0), F.floor(low / 9999) + 1, low % 9999 + 1
        )

    area, group, serial = (F.get(F.split(value, "-"), F.lit(i)).cast("int") for i in range(3))
    number = (area - 1 - F.when(area > 666, 1).otherwise(0)) * SSN_SIZES[1] + (group - 1) * 9999 + serial - 1
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _let(permuted_number(number, SSN_SIZES, key, "ssn"), present)).otherwise(value)


def _ipv4(value: Column, key: str) -> Column:
    octets = [F.get(F.split(value, r"\."), F.lit(i)).cast("long") for i in range(4)]
    number = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    present = lambda moved: F.concat_ws(
        ".", *[(F.floor(moved / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)]
    )
    return _let(permuted_number(number, (65536, 65536), key, "ipv4"), present)


def _date(pattern: str) -> Callable[[Column, str], Column]:
    def permute(value: Column, key: str) -> Column:
        return _moved_day(value, pattern, key, lambda day: F.date_format(day, pattern))

    return permute


def _moved_day(value: Column, pattern: str, key: str, present: Callable[[Column], Column]) -> Column:
    first = F.lit(FIRST_DAY).cast("date")

    def move(number: Column) -> Column:
        moved = F.date_add(first, permuted_number(number, DAY_SIZES, key, "date").cast("int"))
        inside = number.isNotNull() & (number >= 0) & (number < DAY_SIZES[0] * DAY_SIZES[1])
        return F.when(inside, _let(moved, present)).otherwise(value)

    return _let(F.date_diff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), first), move)


def _slash_date(value: Column, key: str) -> Column:
    """Month first, or day first where only that is a date; either way the new text reads as the new day."""
    # A day up to the 12th would read as a month, so it is written behind the month: valid either way.
    present = lambda day: F.date_format(day, "MM/dd/yyyy")
    day_first = lambda day: F.when(F.dayofmonth(day) > 12, F.date_format(day, "dd/MM/yyyy")).otherwise(present(day))
    return F.when(
        F.try_to_timestamp(value, F.lit("MM/dd/yyyy")).isNotNull(), _moved_day(value, "MM/dd/yyyy", key, present)
    ).otherwise(_moved_day(value, "dd/MM/yyyy", key, day_first))


def _phone(value: Column, key: str) -> Column:
    """The country code stays; a North American number stays one in its area and exchange."""
    sizes = (800, 8_000_000)

    def permute(digits: Column) -> Column:
        n = F.length(digits)
        last = F.substring(digits, n - 9, F.lit(10))
        american = last.rlike("^[2-9][0-9]{2}[2-9]") & ((n == 10) | ((n == 11) & F.startswith(digits, F.lit("1"))))
        area, line = F.substring(last, 1, 3).cast("long"), F.substring(last, 4, 7).cast("long")
        moved = permuted_number((area - 200) * sizes[1] + line - 2_000_000, sizes, key, "phone")
        as_american = _let(moved, lambda m: F.concat(
            F.substring(digits, F.lit(1), n - 10), (F.floor(m / sizes[1]) + 200).cast("string"),
            (m % sizes[1] + 2_000_000).cast("string"),
        ))
        kept = F.when(n >= 10, n - 7).otherwise(2).cast("int")
        elsewhere = F.concat(
            F.substring(digits, F.lit(1), kept),
            permuted_string(F.substring(digits, kept + 1, n), [DIGITS], key, "phone"),
        )
        return _refill(value, F.when(american, as_american).otherwise(elsewhere), "0-9")

    return _let(_digits(value), permute)


def _email(value: Column, key: str) -> Column:
    """The local part is permuted within its shape; letters of other scripts become ``x`` first."""
    local, domain = F.split(value, "@")[0], F.split(value, "@")[1]
    known = F.regexp_replace(local, f"[^0-9A-Za-z._%+{LATIN_LOWER}{LATIN_UPPER}-]", "x")
    moved = permuted_string(known, [DIGITS, LOWER, UPPER, LATIN_LOWER, LATIN_UPPER], key, "email")
    return F.concat(moved, F.lit("@"), domain)


def _secret(value: Column, key: str) -> Column:
    """Hexadecimal digits stay hexadecimal; mixed case becomes upper case."""
    upper = permuted_string(F.upper(value), [HEX_UPPER], key, "secret")
    return F.when(value.rlike("[A-F]"), upper).otherwise(permuted_string(value, [HEX_LOWER], key, "secret"))


#: Kind, whole-value pattern, pseudonym: the first kind that fits a found value decides.
KINDS: list[tuple[str, str, Callable[[Column, str], Column]]] = [
    ("email", EMAIL, _email),
    ("secret", SECRET, _secret),
    ("iban", IBAN, _iban),
    ("ipv4", IPV4, _ipv4),
    ("date", ISO_DATE, _date("yyyy-MM-dd")),
    ("date", DOT_DATE, _date("dd.MM.yyyy")),
    ("date", SLASH_DATE, _slash_date),
    ("ssn", SSN, _ssn),
    ("card", CARD, _card),
    ("phone", PHONE, _phone),
]


def pseudonym(value: Column, key: str) -> Column:
    """Pseudonym of a found value; the value itself if it is not valid."""
    result = value
    for _, pattern, permute in reversed(KINDS):
        result = F.when(value.rlike(f"^(?:{pattern})$"), permute(value, key)).otherwise(result)
    return result


def _valid_spans(text: Column, longest: str, group: str, valid: Callable[[Column], Column], usual: Callable[[Column], Column]) -> Column:
    """Distinct valid spans ``s`` of ``text`` that end between groups: the ``usual`` ones first, then the longer ones."""

    def cuts(found: Column) -> Column:
        upto = lambda groups: F.transform(
            F.sequence(F.lit(1), F.size(groups)), lambda n: F.regexp_replace(F.array_join(F.slice(groups, 1, n), ""), "[ -]$", "")
        )
        return _let(F.regexp_extract_all(found, F.lit(group), F.lit(0)), upto)

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(longest), F.lit(1)))
    spans = F.filter(F.array_distinct(F.flatten(F.transform(found, cuts))), valid)
    return F.sort_array(F.transform(spans, lambda s: F.struct(
        (~usual(s)).alias("odd"), (-F.length(s)).alias("shorter"), s.alias("s")
    )))


def _valid_card(s: Column) -> Column:
    return s.rlike(f"^(?:{CARD})$") & (luhn_sum(_digits(s)) % 10 == 0)


def _valid_iban(s: Column) -> Column:
    plain = F.regexp_replace(s, " ", "")
    return s.rlike(f"^(?:{IBAN})$") & (mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _alternatives(spans: Column, start: str, end: str) -> Column:
    """Pattern of the spans; an odd one is none where a usual one begins within it. Empty without spans."""

    def alternative(span: Column) -> Column:
        begins = lambda other: F.contains(span["s"], F.regexp_extract(other["s"], "^[A-Z0-9]+", 0).substr(F.lit(1), F.lit(4)))
        within = F.transform(F.filter(spans, lambda other: ~other["odd"] & begins(other)), lambda other: other["s"])
        unless = F.concat(
            F.lit("(?![A-Z0-9 -]{1,"), (F.length(span["s"]) - 1).cast("string"), F.lit("}(?<![A-Z0-9])(?:"),
            F.array_join(within, "|"), F.lit(f"){end})"),
        )
        return F.concat(F.when(span["odd"] & (F.size(within) > 0), unless).otherwise(""), span["s"])

    return F.when(F.size(spans) > 0, F.concat(
        F.lit(f"{start}(?:"), F.array_join(F.transform(spans, alternative), "|"), F.lit(f"){end}")
    )).otherwise("")


def _search_pattern(cards: Column, ibans: Column) -> Column:
    """What is searched in a text that holds these valid cards and IBANs."""
    usual = F.array_join(F.transform(F.filter(cards, lambda c: ~c["odd"]), lambda c: c["s"]), "|")
    inside = F.when(usual != "", F.concat(F.lit("(?![ -](?:"), usual, F.lit(f"){CARD_END})"))).otherwise("")
    # \u0001 to \u0003 stand for what differs by text.
    parts = {
        "\u0001": _alternatives(ibans, r"(?<![\p{L}\p{N}])", IBAN_END), "\u0002": _alternatives(cards, CARD_START, CARD_END),
        "\u0003": inside,
    }
    pattern = F.lit(_any(*parts))
    for mark, part in parts.items():
        # An alternative that is empty matches nothing.
        pattern = F.replace(pattern, F.lit(mark), part if mark == "\u0003" else F.when(part == "", "(?!)").otherwise(part))
    return pattern


def pseudonymise(docs: DataFrame, key: str, counted: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced.

    ``counted`` names a column to add with the number of values replaced.
    """
    found, new = fresh_name(docs, "pii_found"), fresh_name(docs, "pii_new")
    cards, ibans, pattern = (fresh_name(docs, f"pii_{name}") for name in ("cards", "ibans", "pattern"))
    text = F.col("text")
    spans = docs.withColumns({
        cards: F.when(text.rlike(CARDS_FROM), _valid_spans(text, CARDS_FROM, "[0-9]+[ -]?", _valid_card, lambda s: s.rlike(USUAL_CARD))),
        ibans: F.when(text.rlike(IBANS_FROM), _valid_spans(
            text, IBANS_FROM, "[A-Z0-9]+ ?", _valid_iban, lambda s: F.regexp_replace(s, " ", "").rlike(USUAL_IBAN)
        )),
    })
    none = F.array().cast("array<struct<odd: boolean, shorter: int, s: string>>")
    some = (F.size(F.coalesce(F.col(cards), none)) > 0) | (F.size(F.coalesce(F.col(ibans), none)) > 0)
    searched = spans.withColumn(
        pattern, F.when(some, _search_pattern(F.coalesce(F.col(cards), none), F.coalesce(F.col(ibans), none)))
    ).withColumn(found, F.when(F.col(pattern).isNotNull(), F.regexp_extract_all(text, F.col(pattern), F.lit(0))).when(
        text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    ))
    permuted = searched.withColumn(new, F.transform(found, lambda value: pseudonym(value, key)))
    hit = F.size(F.coalesce(F.col(found), F.array().cast("array<string>"))) > 0
    between = F.when(F.col(pattern).isNotNull(), F.split(text, F.col(pattern), -1)).otherwise(F.split(text, ANY, -1))
    pieces = F.zip_with(between, F.concat(F.col(new), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    changes = {"text": F.when(hit, F.array_join(pieces, "")).otherwise(text)}
    if counted:
        changed = F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)
        changes[counted] = F.when(hit, F.size(changed)).otherwise(0)
    result = permuted.withColumns(changes)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns, *([counted] if counted else []))
