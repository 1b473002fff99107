import re
from datetime import date, datetime

import pytest

from latewatch.llm import pii
from .support import documents, rows

KEY = b"a test key"
VALUES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "3782 822463 10005"],
    "phone": ["+1 (415) 555-2671", "(415) 555-2671", "415-555-2671", "+49 30 901820", "1-415-555-2671", "+1 (017) 555-7713"],
    "ipv4": ["97.51.17.173", "8.8.8.8"],
    "ssn": ["123-45-6789"],
    "date": ["2024-02-29", "1999/12/31", "03/14/2020", "25/12/2021", "14.03.2020"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "email": ["john.34@mail7.example.com", "A_b+c9@x.org"],
}
KEPT = ["4111111111111112", "999.1.1.300", "2023-02-30", "31/02/2020", "000-12-3456", "12345", "3.14", "no digits", "DE00370400440532013000", "@", "a@b", "v1.2.3"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_keyed_permutation(n):
    f, g = pii.Feistel(KEY, "t", n), pii.Feistel(b"other", "t", n)
    there = [f.permute(x) for x in range(n)]
    assert sorted(there) == list(range(n)) and [f.permute(x, back=True) for x in there] == list(range(n))
    assert n < 10 or there != [g.permute(x) for x in range(n)] != [pii.Feistel(KEY, "u", n).permute(x) for x in range(n)]


@pytest.mark.parametrize("kind", VALUES)
def test_format_validity_and_way_back(kind):
    own, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, back=True)
    for value in VALUES[kind]:
        new, found = own.replace(f"see {value}, please")
        assert found == {kind: 1}, (value, new, found)
        got = new[4:-8]
        assert got != value and value not in new
        if kind not in ("ipv4",):
            assert re.sub("[A-Za-z]", "a", re.sub(r"\d", "9", got)) == re.sub("[A-Za-z]", "a", re.sub(r"\d", "9", value))
        assert back.replace(new)[0] == f"see {value}, please"


def test_pseudonyms_are_valid():
    own = pii.Pseudonyms(KEY)
    for value in VALUES["card"]:
        d = re.sub(r"\D", "", own.card(value))
        assert pii.luhn_digit(d[:-1]) == d[-1]
    assert all(pii.iban_digits((s := own.iban(v).replace(" ", ""))[:2], s[4:]) == s[2:4] for v in VALUES["iban"])
    y, m, d = map(int, own.date("2024-02-29").split("-"))
    assert date(y, m, d)


def test_equal_values_stay_linked():
    own = pii.Pseudonyms(KEY)
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(own.card("4111111111111111")) == digits(own.card("4111 1111 1111 1111"))
    assert digits(own.phone("+1 (415) 555-2671"))[1:] == digits(own.phone("415-555-2671"))
    assert own.date("2020-03-14").replace("-", "") == "".join(reversed(own.date("14.03.2020").split(".")))
    assert own.email("Ab@x.org").lower() == own.email("ab@x.org")


def test_what_is_not_valid_stays():
    own = pii.Pseudonyms(KEY)
    for value in KEPT:
        assert own.replace(f"x {value} y") == (f"x {value} y", {})
    two = "4111111111111111 5500000000000004"
    new, found = own.replace(two)
    assert found == {"card": 2} and not set(two.split()) & set(new.split())


IBAN, CARD = "DE89370400440532013000", "4111 1111 1111 1111"


@pytest.mark.parametrize("text,value", [
    (f"IBAN {IBAN} BIC COBADEFFXXX", IBAN), (f"{IBAN} EUR 50", IBAN), (f"paid {IBAN} 2024-01-02", IBAN), (f"AB12 {IBAN} A", IBAN), ("REF GB82 WEST 1234 5698 7654 32 BIC X", "GB82 WEST 1234 5698 7654 32"),
    (f"in 2024 {CARD}", CARD), (f"in 2024 {CARD} 2025", CARD), (f"0001 0002 {CARD}", CARD), ("no 12 5500-0000-0000-0004 7", "5500-0000-0000-0004"), ("+49 30 901820 2024-01-02", "+49 30 901820")])
def test_values_beside_words_and_digits(text, value):
    for key in range(40):  # some pseudonyms would make the longer reading valid
        new, found = pii.Pseudonyms(b"%d" % key).replace(text)
        before, after = text.split(value)
        alone, spans = pii.Pseudonyms(b"%d" % key).replaced(text)
        assert new.startswith(before) and sum(found.values()) == 1 + ("2024-01-02" in text)
        assert new != text and new[len(before):len(before) + len(value)] != value
        assert "2024-01-02" in text or new.endswith(after)
        assert alone == new and new[len(before):len(before) + len(value)] == pii.Pseudonyms(b"%d" % key).replace(value)[0]
        assert pii.Pseudonyms(b"%d" % key, back=True).replaced(new, spans)[0] == text


def test_neighbours_do_not_change_a_pseudonym():
    for key in range(1000):
        own, back = pii.Pseudonyms(b"%d" % key), pii.Pseudonyms(b"%d" % key, back=True)
        alone = own.replace(CARD)[0]
        new, spans = own.replaced(f"2024 {CARD} 17")
        assert new == f"2024 {alone} 17" and back.replaced(new, spans)[0] == f"2024 {CARD} 17"


def test_every_spelling_of_a_date_gets_the_same_day():
    own, back = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, back=True)
    seen = set()
    for n in range(0, 73_049, 61):
        d = date.fromordinal(date(1900, 1, 1).toordinal() + n)
        forms = ["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y"] + ["%d/%m/%Y"] * (d.day > 12)
        new = [own.date(d.strftime(f)) for f in forms]
        read = {datetime.strptime(x, f).date() for x, f in zip(new, forms, strict=True)}
        assert len(read) == 1 and [back.date(x) for x in new] == [d.strftime(f) for f in forms]
        assert (min(read).day > 12) == (d.day > 12)
        seen |= read
    assert len(seen) == len(range(0, 73_049, 61))
    with pytest.raises(ValueError):
        back.replaced("no date here", [("date", 0, 40)])
    with pytest.raises(ValueError):
        back.replaced("no 2023-02-30", [("date", 3, 10)])


def test_odd_rows_and_links_across_documents(spark):
    texts = [None, "", "call (415) 555-2671 now", "or +1 415 555 2671", "1.2.3.4 " * 5000, "mail a.b@c.de"] + ["a" * 300_000 + "@"] + ["x@" * 1000, "٣٤٥-٦٧-٨٩٠١ ²²²"]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in rows(pii.pseudonymise(docs.unionByName(docs), KEY))}
    n = len(texts)
    assert got[n]["text"] is None and got[n - 1]["text"] == "" and got[n]["n_replaced"] == 0
    assert got[n - 4]["n_ipv4"] == 5000 and len(set(got[n - 4]["text"].split())) == 1
    assert re.sub(r"\D", "", got[n - 2]["text"]) == re.sub(r"\D", "", got[n - 3]["text"])[1:]
    assert got[1]["text"] == texts[-1]
    back = {r["doc_id"]: r["text"] for r in rows(pii.pseudonymise(spark.createDataFrame([(k, r["text"], r["spans"]) for k, r in got.items()], "doc_id long, text string, spans array<struct<kind:string,begin:int,length:int>>"), KEY, back=True))}
    assert back == {n - i: t for i, t in enumerate(texts)}
    assert pii.pseudonymise(docs.where("false"), KEY).count() == 0
