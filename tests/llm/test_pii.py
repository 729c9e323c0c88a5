import hashlib
import random
import re

from pyspark.sql import functions as F
from tests.llm.helpers import documents, frame
from touchline.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(k, m[0])]
    return [sum(s[3] == k for s in found) for k in BASE], ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


PARTS = ["a@b.c", "x.y@m-1.example.com", "_", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.4", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "+1 (017) 555-7713", "+", "(", " ", "é", "😀", "-", "12", "5", "a", "+49-30-1234567-", "call 555-123-4567", "%", "token = \"abcdefabcdef1234\"", "\n"]


def test_base_spans(spark):
    rnd = random.Random(3)
    rows = documents() + [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 16)))) for i in range(500, 1100)]
    rows += [(2000, "1" * 30000 + "." + "a" * 30000 + "." + "1.2." * 5000 + "@" + "b.c" * 5000), (2001, "7 " * 3000), (2002, "a@b.c"), (2002, "a@b.c"), (None, "x a@b.c")]
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pii.personal_data(frame(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        n, spans = brute(t)
        want.append((i, *n, hashlib.sha256(spans.encode()).hexdigest(), spans))
    want.sort(key=str)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    for g, w in zip(got, want, strict=True):
        assert set(filter(None, w[6].split(","))) <= set(g[6].split(","))
    assert pii.personal_data(frame(spark, [])).count() == 0


def test_further_spans_and_redaction(spark):
    rows = [(1, "please call (555) 123-4567 today"), (2, "order 555-123-4567 of the list"), (3, 'my token = "0123456789abcdef0123456789abcdef01234567" ok'), (4, "plain prose of 2024, page 12"), (5, "mail a@b.org now"), (6, None)]
    docs = frame(spark, rows)
    got = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert got[1] == "phone_local:12:26" and got[2] == got[4] == got[6] == "" and got[3].startswith("secret:3:") and got[5] == "email:5:12"
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: "please call [phone_local] today", 2: rows[1][1], 3: 'my [secret]" ok', 4: rows[3][1], 5: "mail [email] now", 6: None}


def valid_iban(digits):
    body = "".join(str(int(c, 36)) for c in digits + "DE00")
    return f"DE{98 - int(body) % 97:02d}" + "".join(f" {digits[i : i + 4]}" for i in range(0, len(digits), 4))


def test_recall_and_precision_on_documents(spark):
    """Spans of each kind planted at random places of real documents, by other templates than those fitted on, are found; documents without are left alone."""
    rnd = random.Random(12)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect() if r.text and "555-" not in r.text and "token" not in r.text and "@" not in r.text]
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    make = {
        "phone_local": lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        "email_words": lambda: f"{rnd.choice(['kim', 'j.doe', 'sales'])} [at] {rnd.choice(['site', 'firm'])} [dot] org",
        "national_id": lambda: f"my ssn: {digits(3)}-{digits(2)}-{digits(4)}",
        "iban": lambda: valid_iban(digits(18)),
        "secret": lambda: f'password="{hashlib.sha1(digits(9).encode()).hexdigest()}',
    }
    rows, planted = [], {}
    for n, (i, text) in enumerate(docs):
        kind = [*make, None][n % 6]
        words = text.split(" ")
        if kind:
            at = rnd.randint(0, len(words))
            words.insert(at, make[kind]())
            planted[i] = kind
        rows.append((i, " ".join(words)))
    got = {r.doc_id: {s.split(":")[0] for s in r.spans.split(",") if s} for r in pii.personal_data(frame(spark, rows)).collect()}
    for kind in make:
        own = [i for i, k in planted.items() if k == kind]
        assert len(own) > 10 and sum(kind in got[i] for i in own) / len(own) >= 0.9, (kind, sum(kind in got[i] for i in own), len(own))
    wrong = sum(bool(got[i] & set(make)) for i, _ in rows if i not in planted)
    assert wrong <= 0.02 * len(rows)


def test_thresholds_keep_every_kind(spark):
    rows = pii._rows(frame(spark, documents()), "doc_id", "text")
    model, thresholds = pii.fit(rows, pii.staged(pii.candidates(rows), "found"))
    assert all(t <= 1 for t in thresholds.values()), thresholds


def test_checks(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(pii.luhn(F.lit("4111111111111111")))
    assert one(pii.mod97(F.lit("GB82 WEST 1234 5698 7654 32"))) == 1 and one(pii.mod97(F.lit("GB82 WEST 1234 5698 7654 33"))) != 1
    assert one(pii.mod97(F.lit(valid_iban("370400440532013000")))) == 1
    assert one(pii.entropy(F.lit("aabb"))) == 1 and one(pii.entropy(F.lit("abcd"))) == 2


def test_own_candidates_that_are_vouched_for(spark):
    rows = [(1, "+1 (555) 123-4567 x"), (2, "no (555) 123-4567 x"), (3, "token = aaaaaaaaaaaaaaaa"), (4, 'token = "0a9b8c7d6e5f4a3b2c1d"'), (5, "123-45-6789 and 000-12-3456"), (6, f"{valid_iban('370400440532013000')} or DE00 3704 0044 0532 0130 00")]
    found = pii.candidates(pii._rows(frame(spark, rows), "doc_id", "text"))
    assert sorted((r["__id"], r.kind, r.label) for r in pii.vouched(found).collect()) == [(1, "phone_local", 1.0), (3, "secret", 0.0), (4, "secret", 1.0), (6, "iban", 1.0)]


def test_redaction_of_rows_that_share_an_id(spark):
    rows = [(1, "plain prose without anything"), (1, "mail me at jo@example.org today"), (None, "ip 10.0.0.1 here"), (None, None), (2, "")]
    docs = frame(spark, rows).withColumn("__id", F.lit(3)).withColumn("spans", F.lit("x"))
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, rows[0][1]), (1, "mail me at [email] today"), (None, "ip [ip] here"), (None, None), (2, "")], key=str)


def test_long_secrets_go_whole(spark):
    secret = "A1b2" * 100
    (row,) = pii.redact(frame(spark, [(1, f'login token = "{secret}" end')])).collect()
    assert secret[-20:] not in row.text


def test_every_document_gives_an_example(spark):
    """None is left out of what the trees are fitted on, however many there are; nor is any own candidate that a check vouches for."""
    rows = [(i, f"plain prose of number {i} and token = {'x' * 16} here") for i in range(4500)]
    rows = pii._rows(frame(spark, rows), "doc_id", "text")
    places = pii.contexts(rows)
    made = pii.planted(places)
    assert places.count() == made.count() == 4500 and made.select("kind", "label").distinct().count() == 2 * len(pii.EXTRA)
    assert pii.vouched(pii.candidates(rows)).count() == 4500
