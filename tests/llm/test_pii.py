"""Pseudonyms against a plain Feistel network, and their formats."""

from __future__ import annotations

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import pii
from fieldpulse.llm.queries import QUERIES

KEY = "k"


def plain_hash(kind, number, *parts):
    return hashlib.sha256("|".join([f"{KEY}|{kind}", str(number), *parts]).encode()).hexdigest()


def plain_number(value, a, b, kind):
    left, right = divmod(value, b)
    for i in range(1, 13):
        if i % 2 == 0:
            left = (left + int(plain_hash(kind, i, str(right))[:15], 16)) % a
        else:
            right = (right + int(plain_hash(kind, i, str(left))[:15], 16)) % b
    return left * b + right


def plain_string(value, alphabets, kind):
    def shifted(half, digest):
        out = ""
        for i, c in enumerate(half):
            at = (i * 4) % (len(digest) - 3)
            plus = int(digest[at:at + 4], 16)
            alphabet = next((x for x in alphabets if c in x), None)
            out += alphabet[(alphabet.index(c) + plus) % len(alphabet)] if alphabet else c
        return out

    size = len(value) // 2
    half, other = value[size:], value[:size]
    for i in range(1, 13):
        digest = plain_hash(kind, i, "0", other) + plain_hash(kind, i, "1", other)
        half, other = other, shifted(half, digest)
    return other + half


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def run(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    return [r["text"] for r in pii.pseudonymise(docs, KEY).orderBy("doc_id").collect()]


def test_numbers_are_permuted(spark):
    for a, b in ((7, 11), (16, 16), (1, 5)):
        rows = spark.range(a * b).select("id", pii.permuted_number(F.col("id"), (a, b), KEY, "x").alias("to")).collect()
        assert [r["to"] for r in rows] == [plain_number(r["id"], a, b, "x") for r in rows]
        assert sorted(r["to"] for r in rows) == list(range(a * b))


def test_strings_are_permuted(spark):
    values = [f"{i:03d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in [*values, "a-B.9", "x" * 300, "7", ""]], "v string")
    alphabets = [pii.DIGITS, pii.LOWER, pii.UPPER]
    rows = df.select("v", pii.permuted_string(F.col("v"), alphabets, KEY, "s").alias("to")).collect()
    assert [r["to"] for r in rows] == [plain_string(r["v"], alphabets, "s") for r in rows]
    assert sorted(r["to"] for r in rows if re.fullmatch(r"\d{3}", r["v"])) == values


@pytest.mark.parametrize(("value", "shape", "valid"), [
    ("4111 1111-1111 1111", r"4\d{3} \d{4}-\d{4} \d{4}", lambda v: luhn(re.sub(r"\D", "", v))),
    ("5500005555555559", r"5\d{15}", luhn),
    ("DE89 3704 0044 0532 0130 00", r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", lambda v: mod97(v.replace(" ", "")[4:] + v[:4]) == 1),
    ("GB29NWBK60161331926819", r"GB\d\d[A-Z]{4}\d{14}", lambda v: mod97(v[4:] + v[:4]) == 1),
    ("219-09-9999", r"\d{3}-\d{2}-\d{4}", lambda v: 0 < int(v[:3]) < 900 and v[:3] != "666" and v[4:6] != "00" and v[7:] != "0000"),
    ("+1 (942) 555-3625", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", None),
    ("+49 30 1234567", r"\+49 \d\d \d{7}", None),
    ("97.164.96.63", r"\d{1,3}(\.\d{1,3}){3}", lambda v: all(int(x) < 256 for x in v.split("."))),
    ("2024-02-29", r"\d{4}-\d\d-\d\d", lambda v: 1800 <= datetime.date.fromisoformat(v).year < 2200),
    ("29.02.2024", r"\d\d\.\d\d\.\d{4}", lambda v: datetime.datetime.strptime(v, "%d.%m.%Y")),
    ("12/31/1999", r"\d\d/\d\d/\d{4}", lambda v: datetime.datetime.strptime(v, "%m/%d/%Y")),
    ("that.30@mail1.example.com", r"[a-z]{4}\.\d\d@mail1\.example\.com", None),
    ("réñ_9@a-b.org", r"[a-z][à-ÿß]{2}_\d@a-b\.org", None),
    ("b44e15e09fd311c3cf3163b66d5a9875b883d8ce", r"[0-9a-f]{40}", None),
    ("9233A8ECF7C5B09FE5949719B6B82BC439E9329B", r"[0-9A-F]{40}", None),
])
def test_values_change_within_their_format(spark, value, shape, valid):
    texts = [value, f"before {value}, after", f"x\n({value})\n{value}.", f"x{value}x"]
    one, inside, twice, glued = run(spark, texts)
    assert one != value and re.fullmatch(shape, one)
    assert valid is None or valid(one)
    assert inside == f"before {one}, after"
    assert twice == f"x\n({one})\n{one}."
    assert "@" in value or value.startswith("+") or glued == f"x{value}x"


def test_invalid_values_and_plain_text_stay(spark):
    texts = [
        "4111 1111 1111 1112", "DE88 3704 0044 0532 0130 00", "666-12-3456", "000-12-3456", "123-00-1234", "999.1.1.1",
        "1.2.3.4.5", "2024-02-30", "31.04.2024", "13/31/1999", "version 3.14 of 42", "a@b", "@name", "12345", "", "No data.",
        "1500-01-01", "deadbeef", None,
    ]
    assert run(spark, texts) == texts


def test_values_of_one_network_against_the_plain_form(spark):
    card, date = run(spark, ["4111111111111111", "2024-02-29"])
    assert card[:-1] == "4" + plain_string("11111111111111", [pii.DIGITS], "card")
    first = datetime.date(1800, 1, 1)
    number = (datetime.date(2024, 2, 29) - first).days
    assert date == str(first + datetime.timedelta(days=plain_number(number, 189, 773, "date")))


def test_equal_days_stay_linked_over_formats(spark):
    iso, dots = run(spark, ["2001-09-03", "03.09.2001"])
    assert iso.split("-") == dots.split(".")[::-1]


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(1, "a@b.org", 7, ["x"]), (1, "a@b.org", 7, ["x"]), (None, None, None, None)],
        "doc_id long, text string, n_chars long, pii_found array<string>",
    )
    got = pii.pseudonymise(docs, KEY, counted="n")
    assert got.columns == [*docs.columns, "n"]
    rows = sorted(map(str, (tuple(r) for r in got.collect())))
    assert rows[0] == rows[1] and "(None, None, None, None, 0)" in rows
    assert pii.pseudonymise(docs.limit(0), KEY).collect() == []


def test_nothing_found_remains_in_the_documents(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    before = dict(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall())
    after = {r["doc_id"]: r for r in QUERIES["op5_pii_pseudonyms"](spark, sf).collect()}
    assert after.keys() == before.keys()
    values = r"[\w.+-]+@[\w.-]+\w|\+\d[\d ()-]{9,}\d|(?<!\w)\d{16}(?!\w)|(?<![\w.])\d+(?:\.\d+){3}(?![\w])|[0-9a-fA-F]{40}"
    total = 0
    for doc_id, text in before.items():
        found = [v for v in re.findall(values, text) if not re.fullmatch(r"\d{16}", v) or luhn(v)]
        total += len(found)
        new = after[doc_id]["text"]
        assert not any(v in new for v in found)
        assert after[doc_id]["n_replaced"] == len(found)
        assert re.sub(values, "", text) == re.sub(values, "", new)
        assert [v for v in re.findall(r"(?<!\w)\d{16}(?!\w)", text) if not luhn(v)] == [
            v for v in re.findall(r"(?<!\w)\d{16}(?!\w)", new) if v in text
        ]
    assert total > 50


CARD16, IBAN_AT = "4111111111111111", "AT611904300234573201"


BESIDE = [
    (CARD16, "", " 12/25"), (CARD16, "2 ", ""), (CARD16, "2 ", " 12/25 123"), (CARD16, "2-", "-123"), (CARD16, "10 ", " 12 25"),
    ("4111 1111 1111 1111", "", " 123"), ("4111 1111 1111 1111", "2 ", " 12/25"), ("4111 1111 1111 1111", "2024 ", " 123"),
    ("4111-1111-1111-1111", "", "-123"), ("4111 1111 1111 1111", "123 456 ", ""),
    ("378282246310005", "", " 1234"), ("3782 822463 10005", "3 ", " 09/27"),
    (IBAN_AT, "", " EUR"), (IBAN_AT, "IBAN ", " BIC"), ("AT61 1904 3002 3457 3201", "", " EUR 12"), (IBAN_AT, "EX12 ", " COBA DEFF"),
    ("NO93 8601 1117 947", "", " NOK"),
]


def test_a_value_beside_other_groups_is_found_as_alone(spark):
    got = run(spark, [text for value, before, after in BESIDE for text in (value, before + value + after)])
    for at, (value, before, after) in enumerate(BESIDE):
        alone, beside = got[2 * at : 2 * at + 2]
        assert alone != value
        assert beside == before + alone + after


def test_card_with_a_neighbour_that_passes_the_check_stays_linked(spark):
    """One of ten neighbours makes a longer span that passes Luhn."""
    texts = [CARD16, *(f"{CARD16} {n:02d}/25" for n in range(1, 32)), *(f"{n} {CARD16}" for n in range(1, 10)),
             *(f"4111 1111 1111 1111 {n}" for n in range(100, 130))]
    assert any(luhn(f"{CARD16}{n:02d}") for n in range(1, 32))
    alone, *beside = (re.sub(r"[^0-9]", "", t) for t in run(spark, texts))
    assert all(alone in t for t in beside)


def test_two_values_side_by_side(spark):
    phone, card = run(spark, ["555-223-4567", "5500 0055 5555 5559"])
    both, cards = run(spark, ["555-223-4567 5500 0055 5555 5559", "5500 0055 5555 5559 5500 0055 5555 5559"])
    assert both == f"{phone} {card}" and cards == f"{card} {card}"


def test_slash_dates_with_the_day_first(spark):
    days = [datetime.date(2024, 1, 13) + datetime.timedelta(days=d) for d in range(0, 340, 3)]
    days = [d for d in days if d.day > 12]
    iso = run(spark, [str(d) for d in days])
    slashes = run(spark, [d.strftime("%d/%m/%Y") for d in days])
    assert len(set(slashes)) == len(days)
    for linked, slash in zip(iso, slashes, strict=True):
        first, second, year = map(int, slash.split("/"))
        assert datetime.date(year, *((first, second) if first <= 12 else (second, first))) == datetime.date.fromisoformat(linked)
        datetime.datetime.strptime(slash, "%d/%m/%Y")


def test_invalid_numbers_beside_others_stay(spark):
    texts = ["4111111111111112 12/25", "2 4111 1111 1111 1112", "AT611904300234573202 EUR", "3056 930902 5905", "32/12/2024"]
    assert run(spark, texts) == texts
