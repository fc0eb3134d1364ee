"""Personal data: base finds against plain expressions, further finds case by case."""

import hashlib
import random
import re
import time

import pytest

from lumentide.llm import queries
from lumentide.llm.pii import KINDS, find_pii, mask_pii, passes_luhn, passes_mod97, scan_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    found = []
    for kind, form in PLAIN.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email"
                    or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                found.append((kind, *m.span()))
    return found


def base(text):
    return [s[:3] for s in find_pii(text) if s.base]


def kinds(text, base=False):
    return [(s.kind, text[s.start:s.end]) for s in find_pii(text) if s.base == base]


def test_base_layer_equals_plain_expressions_on_random_texts():
    random.seed(11)
    parts = ["@", ".", "..", "a", "b1", "-", "+", "+1", " ", "4111 1111 1111 1111", "4", "255",
             "256", "1.2.3.4", "é", "x@y.z", "(", ")", "01", "\n", "%", "+49 (30) 1234-567"]
    for _ in range(20_000):
        text = "".join(random.choices(parts, k=random.randint(1, 14)))
        assert base(text) == brute(text), text


def test_query_equals_brute_force_on_every_document(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op11_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    some = 0
    for r in rows:
        spans = brute(docs[r["doc_id"]] or "")
        some += len(spans)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
        order = [(KINDS.index(k), int(a)) for k, a, _ in
                 (s.split(":") for s in r["spans"].split(",") if s)]
        assert order == sorted(order)
    assert some > 10


def test_checksums():
    assert passes_luhn("4111111111111111") and not passes_luhn("4111111111111112")
    assert passes_mod97("DE89370400440532013000") and not passes_mod97("DE88370400440532013000")


@pytest.mark.parametrize("text, expected", [
    ("pay 4111111111111111 4929348385146306 now", [
        ("card", "4111111111111111"), ("card", "4929348385146306")]),
    ("+1 (826) 555-4081 190.137.223.204 x", [("phone", "+1 (826) 555-4081")]),
    ("IBAN DE89 3704 0044 0532 0130 00 und", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("GB82WEST12345698765432.", [("iban", "GB82WEST12345698765432")]),
    ("DE88 3704 0044 0532 0130 00", []),
    ("host 2a00:1450:4001:81b::200e up", [("ipv6", "2a00:1450:4001:81b::200e")]),
    ("at 10::20 and 12:30:45", []),
    ("SSN: 123-45-6789", [("national_id", "123-45-6789")]),
    ("part 123-45-6789, order 7", []),
    ("call (030) 1234 5678 today", [("local_phone", "(030) 1234 5678")]),
    ("rows 030 1234 5678 today", []),
    ('token = "04dbebab91ab85687d33"', [("credential", "04dbebab91ab85687d33")]),
    ("password: hunterhunter", []),
    ("token = aaaaaaaaaaaaaaaaaaaa1", []),
])
def test_further_finds(text, expected):
    assert kinds(text) == expected


def test_context_moves_the_score_and_never_drops_a_base_find():
    score = lambda t: find_pii(t)[0].score
    number = "4111111111111111"
    assert score(f"isbn {number}") < score(number) < score(f"visa {number}")
    assert find_pii(f"isbn {number}")[0].base


@pytest.mark.parametrize("piece", ["a", "1", "a@", "1.", "+1 ", "1 ", ":a", "DE89 ", "token=", "(030) "])
def test_long_texts_take_linear_time(piece):
    began = time.time()
    find_pii(piece * 200_000)
    assert time.time() - began < 20


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (2, "a@b.cd", "z"), (2, "a@b.cd", "z"), (None, "é 1.2.3.4", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = scan_pii(docs)
    assert got.columns == ["doc_id", "text", "spans"]
    found = sorted((r["doc_id"] or 0, [(s["kind"], s["start"], s["end"]) for s in r["spans"]])
                   for r in got.collect())
    assert found == [(0, [("ip", 2, 9)]), (1, []), (1, []), (2, [("email", 0, 6)]), (2, [("email", 0, 6)])]
    assert scan_pii(docs.limit(0)).count() == 0
    masked = {r["masked"] for r in mask_pii(got).collect()}
    assert masked == {None, "", "<email>", "é <ip>"}
