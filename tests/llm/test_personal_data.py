"""Spans against the plain regular expressions, checksums, context, edge cases."""

import random
import re

from chartdex.llm.personal_data import find_personal_data, find_spans, luhn, mod97

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    order = ("email", "ip", "card", "phone")
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def base_of(text):
    return [s[:3] for s in find_spans(text) if s[0] in ("email", "ip", "card", "phone")]


def test_random_texts_agree_with_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a", "é", "@", ".", "-", " ", "+", "1", "23", "456", "(", ")", "\n", "4111111111111111", "10.0.0.1", "x@y.z", "_%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        assert base_of(text) == plain(text), text


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("DE89370400440532013000") and not mod97("DE89370400440532013001")


def test_method_adds_spans():
    text = "iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789"
    kinds = [(k, text[s:e]) for k, s, e, _ in find_spans(text) if k in ("iban", "ssn")]
    assert kinds == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    assert not [s for s in find_spans("order 123-45-6789 of today") if s[0] == "ssn"]
    assert find_spans("server 10.0.0.1")[0][3] > find_spans("value 10.0.0.1")[0][3]


def test_long_texts_are_linear():
    for piece in ("a", "1", "1 ", "1.", "+1(", "a@", "@"):
        find_spans(piece * 300_000)


def test_documents(spark):
    rows = [(1, "x", "mail a@b.cd"), (2, "x", None), (3, "x", ""), (1, "x", "mail a@b.cd"), (None, "x", "🙂 a@b.cd")]
    docs = spark.createDataFrame(rows, "doc_id long, spans string, text string")
    got = sorted(((r["doc_id"], [tuple(s)[:3] for s in r["spans"]]) for r in find_personal_data(docs).collect()), key=str)
    want = [(1, [("email", 5, 11)])] * 2 + [(2, []), (3, []), (None, [("email", 2, 8)])]
    assert got == sorted(want, key=str)
    assert find_personal_data(docs.limit(0)).count() == 0
