import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from attesta.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = {}
    for kind, pattern in PATTERNS.items():
        found[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found[kind].append(m.span())
    return found


def base_of(text):
    params = pii.PiiParams()
    found = pii.find(text, pii.automaton(params), params)
    return {k: found[k] for k in pii.BASE}


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@+-0123 4(5)%é:/", max_size=40))
def test_base_spans_equal_patterns(text):
    assert base_of(text) == plain(text)


def test_cards_and_long_runs():
    rng = random.Random(2)
    for _ in range(300):
        parts = [rng.choice(["4111 1111-1111 1111", "4111111111111111", "1.2.3.4.5.6.7.8", "+1 (555) 555-2678",
                             "x@y.z", "a@b@c.d", "256.1.1.1", "0001.2.3.4", "1", "12", " ", "-", "é", "."])
                 for _ in range(12)]
        text = "".join(parts)
        assert base_of(text) == plain(text)
    for long in ("1" * 60_000, "a" * 60_000 + "@", "1." * 30_000, "+1" * 20_000, "@" * 50_000, "1 " * 30_000):
        base_of(long)


def test_added_spans():
    params = pii.PiiParams()
    text = "see ftp://user:pw@host/x and http://10.0.0.1/a; IBAN DE89370400440532013000, konto: 1234567, discount 1234567"
    found = pii.find(text, pii.automaton(params), params)
    assert [text[a:b] for a, b in found["account"]] == ["DE89370400440532013000", "1234567"]
    assert [text[a:b] for a, b in found["url"]] == ["ftp://user:pw@host"]  # the other touches its ip
    assert [text[a:b] for a, b in found["ip"]] == ["10.0.0.1"]


def test_query_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.co and é 4111111111111111", "x"), (3, "a@b.co and é 4111111111111111", "x"),
            (None, "+1 (555) 555-2678 " * 4000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = {(r.doc_id, r.n_email, r.n_card, r.n_phone): r for r in pii.find_personal_data(docs).collect()}
    assert set(got) == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 1, 0), (None, 0, 0, 4000)}
    assert got[(1, 0, 0, 0)].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[(3, 1, 1, 0)].spans == "email:0:6,card:13:29"
    assert pii.find_personal_data(docs.limit(0)).collect() == []
