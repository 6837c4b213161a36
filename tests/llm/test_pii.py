"""Base spans against Python's regular expressions; what the trees add."""

import hashlib
import random
import re

from jobsight.llm.pii import BASE, counted_candidates, fit_spans, personal_data, redact, span_digests

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "", re.A) if valid(k, m[0])] for k, p in PLAIN.items()}


def texts():
    rnd = random.Random(2)
    fixed = [None, "", " ", "a@b.c", "x a@b.c_d@e.f, a@b@c.de é@ü.de a.b+c%d@x-y.co.uk.", "1.2.3.4 256.1.1.1 001.002.003.004.5 1.2.3",
             "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112", "+1 (606) 555-7814 +49 30 1234567 + 1 +12", "\U0001f600 a@b.cd \U0001f600 10.0.0.1",
             "9" * 5000, "1 " * 6000, "a" * 20000 + "@", "a.b" * 9000 + "@x" + ".y" * 5000, "+1" * 3000, "+" + "1-" * 9000, "1." * 9000, "0000000000000 0"]
    alphabet = "ab.@+-_% ()0123456789é\U0001f600,"
    return fixed + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(400)]


def test_base_spans(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows + [(None, "a@b.cd", None, None)] * 2, "doc_id long, text string, base string, email int")
    got = personal_data(docs, None).collect()
    assert len(got) == len(rows) + 2
    by = {r["doc_id"]: r for r in got}
    for i, t, _, _ in rows:
        assert {k: [tuple(s) for s in by[i][k]] for k in BASE} == brute(t), repr(t)[:100]
    digests = {r["doc_id"]: r for r in span_digests(personal_data(docs, None)).collect()}
    for i, t, _, _ in rows:
        want = ",".join(f"{k}:{s}:{e}" for k, found in brute(t).items() for s, e in found)
        assert digests[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and digests[i]["spans"] == want
    assert personal_data(docs.limit(0), None).collect() == []
    assert fit_spans(docs.limit(0)) is None


def test_added_spans_and_redaction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = fit_spans(docs)
    assert model is not None
    extra = spark.createDataFrame([(1, "das password=b2b9b9e417188fbb01 x mail: ann@mail2.example.com, call +1 (606) 555-7814"),
                                   (2, "plain words only, of 3 lines and 12 dots.")], "doc_id long, text string")
    found = personal_data(extra, model)
    out = {r["doc_id"]: r["text"] for r in redact(found).collect()}
    assert out[2] == "plain words only, of 3 lines and 12 dots."
    assert out[1].startswith("das [") and "b2b9" not in out[1] and out[1].endswith("mail: [email], call [phone]")
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in personal_data(small, model).filter("size(added) > 0").collect():
        base = [tuple(s) for k in BASE for s in r[k]]
        spans = [(s["start"], s["end"]) for s in r["added"]]
        assert not any(a < y and x < b for a, b in spans for x, y in base)
        assert not any(a < y and x < b for i, (a, b) in enumerate(spans) for x, y in spans[:i])


def test_every_document_is_fitted_on(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'call 555 123 4567 now' ELSE 'no number here' END AS text")
    rows = counted_candidates(docs).collect()
    assert sum(r["n"] for r in rows) == 10_000
    assert sorted((r["half"], r["kind"]) for r in rows) == [(0, 1), (1, 1)]
