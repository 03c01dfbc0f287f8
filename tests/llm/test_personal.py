import re

import pytest

from loomfeed.llm import personal
from loomfeed.llm.common import store
from loomfeed.llm.queries import QUERIES
from tests.llm import brute
from tests.conftest import node_names

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    def number(m):
        return re.sub("[^0-9]", "", m[0])

    checks = [
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", CARD, lambda m: 14 <= len(number(m)) <= 19 and luhn(number(m))),
        ("phone", PHONE, lambda m: 10 <= len(number(m)) <= 15),
    ]
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern, check) in enumerate(checks)
        for m in pattern.finditer(text or "")
        if check(m)
    ]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def rows_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = personal.find_personal(docs)
    return [r["personal"] for r in found.orderBy("doc_id").collect()]


def as_text(spans):
    return [f"{s['kind']}:{s['start']}:{s['stop']}" for s in spans]


TEXTS = [
    None, "", " ", "é a@b.c_d@e.f ä", "a@b", "a@b.", "x.y@z-.1.2.3", "@a.b", "..@a.b.c.", "a@b.c@d.e", "a@b..c@d.e",
    "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.1.001", "1.2.3", "1.2.3.4 1.2.3.400", "v1.2.3.4x",
    "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111 ", "4111  1111 1111 1111", "41111111111111112",
    "00000000000000", "0" * 19, "0" * 20, "1 4111111111111111", "4111111111111111-4111111111111111", "9" * 5000,
    "+1 (873) 555-4517", "+1 (873) 555-4517 4111111111111111", "+12", "+1234567890", "++49 30 1234567.", "+1 2 3 4 5 6 7 8 9 0 )(",
    "+1" + "2" * 13, "+1" + "2" * 15, "😀 +1 873 555 4517 😀 a@b.cd", "a" * 3000 + "@b.c", "b." * 4000 + "@x.y", "a@b" + ".c" * 20000,
    "x@" * 3000, "1." * 3000 + "1", "mail a@b.c\nip 10.0.0.1\ncard 4111111111111111\nphone +1 (873) 555-4517",
    "+49 1.2.3.4 5", "4111.1111.1111.1111", "a@1.2.3.4", "١٢٣.1.1.1", "ａ@b.c",
]


def test_base_spans_equal_python(spark):
    found = rows_of(spark, TEXTS)
    for text, spans in zip(TEXTS, found, strict=True):
        assert as_text(s for s in spans if s["base"]) == base(text), (text or "")[:60]
        order = [(s["start"], s["order"]) for s in spans]
        assert order == sorted(order)


def test_whole_documents_equal_python(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op11_personal"](spark, folder)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    totals = [0] * 4
    for r in got.collect():
        listed = base(texts[r["doc_id"]])
        counts = [sum(x.startswith(f"{k}:") for x in listed) for k in personal.BASE_KINDS]
        assert (list(r[1:5]), r["base_sha256"]) == (counts, brute.sha256(",".join(listed)))
        assert set(listed) <= set(r["spans"].split(","))
        totals = [a + b for a, b in zip(totals, counts, strict=True)]
    assert min(totals) > 10


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("IBAN DE89 3704 0044 0532 0130 00.", ["account"]),
        ("account GB82WEST12345698765432", ["account"]),
        ("account GB82WEST12345698765433", []),
        ("DE88 3704 0044 0532 0130 00", []),
        ("my SSN is 078-05-1120", ["national_id"]),
        ("invoice 078-05-1120", []),
        ("SSN 000-05-1120, 666-05-1120, 078-00-1120", []),
        ("call (030) 123-4567 now", ["local_phone"]),
        ("(030) 123-4567", []),
        ("visa 4222222222222", ["card"]),
        ("serial 4222222222222", []),
        ("order 4111111111111111", ["card"]),
    ],
)
def test_validators_and_context_decide(spark, text, kinds):
    (spans,) = rows_of(spark, [text])
    assert [s["kind"] for s in spans] == kinds
    assert all(0 <= s["score"] <= 1 for s in spans)


def test_many_spans_in_a_long_text(spark):
    text = " ".join(f"u{i}@example.com 10.0.{i % 256}.{i % 250} é" for i in range(20_000))
    (spans,) = rows_of(spark, [text])
    assert as_text(spans) == base(text)


def test_plan_has_no_python_and_no_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = personal.find_personal(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert {"Project", "LogicalRelation"} == node_names(found) or "Join" not in node_names(found)


def test_unusual_tables(spark):
    names = ["personal", "whole", "kind_0", "kind_0_found", "kind_0_gaps", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    row = (None, "a@b.c", *names)
    docs = store(spark.createDataFrame([row, row, (1, None, *names)], schema), "personal-names")
    found = personal.find_personal(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    rows = found.collect()
    assert sorted(len(r["personal"]) for r in rows) == [0, 1, 1] and all(r["a.b"] == "a.b" for r in rows)
    assert personal.find_personal(docs.filter("false")).count() == 0
    digest = found.select("doc_id", *personal.digests(found)).filter("n_email = 0").first()
    assert digest["base_sha256"] == brute.sha256("") and digest["spans"] == ""
