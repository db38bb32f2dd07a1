import datetime
import hashlib
import ipaddress
import os
import re

import pytest

from tallyweave.llm import pii, queries
from tests.llm.cases import documents, prose

SF = "/root/testdata/sf0.001"

KEY = b"k"
TEXTS = [
    None, "", "no data 12 here", "card 4845168114407329 and 4845-1681-1440-7329, not 9807915762804490", "two 7536784127813050 4845168114407329 end",
    "call +1 (843) 555-7672 170.106.47.218 or +1 (017) 555-7713%%%", "mail ann.lee42@mail7.example.com, une oi.78@mail3.example.com.", "born 2001-02-29, 2004-02-29 or 31/12/1999 or 3.4.2020 or 12/31/1999",
    "on 12 March 2020 and March 5, 2021", "ssn 123-45-6789 and 000-12-3456", "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "ip 999.1.1.1 and 10.0.0.255", "again 4845168114407329",
]


def luhn(s):
    return pii.luhn_digit(s[:-1]) == s[-1]


def test_formats_hold_equal_values_stay_linked_and_the_key_inverts(spark):
    docs = documents(spark, TEXTS)
    got = {r.doc_id: r for r in pii.pseudonymise(docs, KEY).collect()}
    assert got[0].text is None and got[1].text == "" and got[2].text == TEXTS[2] and not got[2].found
    cards = re.findall(r"[\d-]{16,}", got[3].text)
    assert luhn(cards[0]) and luhn(cards[1].replace("-", "")) and cards[0] == cards[1].replace("-", "") != "4845168114407329"
    assert cards[2] == "9807915762804490"  # fails its check: not a card
    assert got[12].text == f"again {cards[0]}" and got[4].text.split()[2] == cards[0] and luhn(got[4].text.split()[1])
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+ or \+1 \(\d{3}\) \d{3}-\d{4}%%%", got[5].text) and "843" not in got[5].text[:15]
    assert "ann.lee42" not in got[6].text and "@mail7.example.com" in got[6].text and re.search(r"une [a-z]{2}\.\d\d@mail3", got[6].text)
    a, b, c, d, e = re.findall(r"[\d./-]{6,}", got[7].text.replace(",", " "))
    assert a == "2001-02-29" and b != "2004-02-29" and datetime.date.fromisoformat(b) and re.fullmatch(r"\d\d/\d\d/\d{4}", c) and re.fullmatch(r"\d{1,2}\.\d{1,2}\.\d{4}", d)
    assert int(e.split("/")[1]) > 12
    assert re.fullmatch(r"on \d+ [A-Z]\w+ \d{4} and [A-Z]\w+ \d+, \d{4}", got[8].text)
    assert "123-45-6789" not in got[9].text and "000-12-3456" in got[9].text
    for s in re.findall(r"[A-Z]{2}\d{2}[A-Z0-9 ]+(?= and|$)", got[10].text):
        assert pii._iban_rest(s.replace(" ", "")) == 1
    assert "999.1.1.1" in got[11].text and "10.0.0.255" not in got[11].text
    assert [k.kind for k in got[3].found] == ["card", "card"] and TEXTS[3][got[3].found[0].start : got[3].found[0].end] == "4845168114407329"
    back = {r.doc_id: r.text for r in pii.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in got.values()], "doc_id long, text string"), KEY, inverse=True).collect()}
    assert back == dict(enumerate(TEXTS))
    other = {r.doc_id: r.text for r in pii.pseudonymise(docs, b"other").collect()}
    assert other[12] != got[12].text
    rows = pii.pseudonymise_rows(docs, KEY)
    assert rows.columns == docs.columns and {r.doc_id: r.text for r in rows.collect()} == {k: v.text for k, v in got.items()}
    assert pii.pseudonymise(docs.where("false"), KEY).count() == 0


def test_an_address_of_short_parts_alone(spark):
    docs = documents(spark, ["8.8.8.8", "8.8.8.8 and 12"])
    alone, more = (r.text for r in pii.pseudonymise(docs, KEY).orderBy("doc_id").collect())
    assert alone != "8.8.8.8" and more == f"{alone} and 12"
    assert [r.text for r in pii.pseudonymise_rows(docs, KEY).orderBy("doc_id").collect()] == [alone, more]


def test_letters_keep_their_case_and_alphabet_and_invert(spark):
    texts = ["John.Smith@x.com", "john.smith@x.com", "jöRg.Ünal42@y.de", "am 3. März 1999", "le 14 juillet 1989", "el 5 de mayo de 2001", "+49 30 12345678", "+33 1 23 45 67 89", "on 1 May 1850", "tel 12 34 56 78"]
    got = [r.text for r in pii.pseudonymise(documents(spark, texts), KEY).orderBy("doc_id").collect()]
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{4}@x\.com", got[0]) and got[1] == got[0].lower() != texts[1]
    assert re.fullmatch(r"[a-z]\w[A-Z][a-z]\.\w[a-z]{3}\d\d@y\.de", got[2]) and got[2][1].islower() and got[2][5].isupper() and not got[2].isascii()
    assert re.fullmatch(r"am \d+\. \w+ \d{4}", got[3]) and re.fullmatch(r"le \d+ \w+ \d{4}", got[4]) and re.fullmatch(r"el \d+ de \w+ de \d{4}", got[5])
    assert re.fullmatch(r"\+49 \d\d \d{8}", got[6]) and re.fullmatch(r"\+33 \d( \d\d){4}", got[7]) and got[8:] == texts[8:]
    assert all(a != b for a, b in zip(got[:8], texts[:8], strict=True))
    back = [r.text for r in pii.pseudonymise(documents(spark, got), KEY, inverse=True).orderBy("doc_id").collect()]
    assert back == texts


def plain_card(digits, key):
    """Eight rounds of an alternating Feistel network over the number without its check digit, then a new check digit."""
    size = 10 ** (len(digits) - 1)
    a = next(x for x in range(int(size**0.5), size + 2) if x * x >= size)
    b, x = -(-size // a), int(digits[:-1])
    while True:
        x, y = divmod(x, b)
        for i in range(8):
            h = lambda v: int.from_bytes(hashlib.blake2b(b"card:%d|%d|%d" % (size, i, v), key=key, digest_size=16).digest(), "little")
            x, y = (x, (y + h(x)) % b) if i % 2 else ((x + h(y)) % a, y)
        x = x * b + y
        if x < size:
            body = str(x).zfill(len(digits) - 1)
            return next(body + c for c in "0123456789" if luhn_valid(body + c))


def luhn_valid(digits):
    return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(digits))) % 10 == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_query_against_plain_rules(spark):
    """On every document: only the spans change, each value has one pseudonym, and no value that simple rules see is left."""
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    made, seen = {}, {}
    for r in queries.op10_pii_pseudonyms(spark, SF).collect():
        old, spans = before[r.doc_id] or "", [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert r.n_found == len(spans)
        at, parts = 0, []
        for _, s, e in spans:
            parts += [re.escape(old[at:s]), "(.{1,60}?)"]
            at = e
        m = re.fullmatch("".join([*parts, re.escape(old[at:])]), r.text or "", re.S)
        assert m
        covered = set()
        for (kind, s, e), new in zip(spans, m.groups(), strict=True):
            value = old[s:e]
            covered.update(range(s, e))
            if kind in ("card", "ssn", "phone", "email"):
                assert re.sub("[a-z]", "a", re.sub("[0-9]", "9", new)) == re.sub("[a-z]", "a", re.sub("[0-9]", "9", value))
            if kind == "card":
                assert re.sub("[^0-9]", "", new) == plain_card(re.sub("[^0-9]", "", value), queries.pseudonym_key(spark))
            if kind == "ip":
                assert ipaddress.ip_address(new) != ipaddress.ip_address(value)
            assert made.setdefault((kind, value), new) == new and seen.setdefault((kind, new), value) == value
        for x in re.finditer(r"(?<![\w.+-])[0-9]{16}(?![\w-])", old):
            assert x.start() in covered or not luhn_valid(x[0])
        for pattern in (r"(?<![\w.+%-])[\w.+%-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9]+", r"(?<![\w.+-])[1-8][0-9]{2}-[0-9][1-9]-[0-9]{3}[1-9](?![\w-])", r"\+[0-9] \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![\w-])"):
            assert all(x.start() in covered for x in re.finditer(pattern, old) if not x[0].startswith("666"))
    assert len(made) > 5


def test_long_repeated_and_null_rows(spark):
    import random

    long = prose(random.Random(3), 30_000)
    texts, ids = [f"{long} 8.8.8.8 {long}", "x@y.com", "x@y.com", None], [None, 4, 4, None]
    got = pii.pseudonymise(documents(spark, texts, ids), KEY).collect()
    alone = next(r.text for r in pii.pseudonymise(documents(spark, ["8.8.8.8"]), KEY).collect())
    assert sorted(str(r.text) for r in got if r.doc_id is None) == sorted(["None", f"{long} {alone} {long}"])
    assert len({r.text for r in got if r.doc_id == 4}) == 1


def test_permutations_are_bijections():
    for size in (1, 2, 10, 97, 1000):
        p = pii.Permutation(KEY, "t", size)
        images = [p.forward(x) for x in range(size)]
        assert sorted(images) == list(range(size)) and [p.backward(x) for x in images] == list(range(size))


def test_permutations_of_any_size_start_at_once():
    for size in (1, 2, 3, 26**41, 26**64, 10**64, 120**64):
        p = pii.Permutation(b"k", "name", size)
        assert p.a * p.a >= size and (p.a - 1) ** 2 < size
        for x in {0, size // 3, size - 1}:
            assert p.backward(p.forward(x)) == x


@pytest.mark.parametrize("name", ["a" * 41, "abcde" * 12 + "abcd", "0123456789" * 6 + "0123", "é" * 64, "Ab1" * 21])
def test_long_email_names(spark, name):
    text = f"write to {name}@example.org today"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    made = pii.pseudonymise(docs, b"key").first()["text"]
    back = pii.pseudonymise(spark.createDataFrame([(1, made)], docs.schema), b"key", inverse=True).first()["text"]
    assert back == text
