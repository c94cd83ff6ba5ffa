from __future__ import annotations

import hashlib
import re

from ledgerline.llm import pii
from pyspark.sql import functions as F

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    None, "", "no data", "a@b.c_x@d.e f@g", "a@b.c@d.e", "é😀 x.y@mail-1.example.com, z", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255",
    "0000000300.1.1.1 12.13.14.15", "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111112", "5-5-5-5-5-5-5-5 7992739871300000000",
    "+1 (743) 555-3824, +12 34 +1-2 +123456789012345678 +1..2", "+49 30 1234567 4532015112830366 mail me a.b@c.org. 10.0.0.1",
    "@" * 2000 + "a" * 4000 + "9" * 3000, "4 " * 5000, "a@b." + "c." * 3000 + "d", "1." * 4000, "😀1.2.3.4😀5.6.7.8",
    "write to john.doe at example dot com or jane (at) site.org", "call (310) 555-4510 or 310-555-4510", "card 3782 822463 10005",
]


def test_base_spans_equal_the_patterns(docs_of):
    docs = docs_of(*enumerate(TEXTS), (None, TEXTS[6]), (5, TEXTS[5]))
    got = pii.detect(docs).select("doc_id", pii.as_text(F.col("base")).alias("base"), pii.as_text(F.col("spans")).alias("spans")).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert r.base == brute(TEXTS[6 if r.doc_id is None else r.doc_id])
        assert set(r.base.split(",")) <= set(r.spans.split(",")) | {""}


def test_votes_of_a_corpus_add_spans(spark, docs_of):
    rows = [(i, f"call +1 ({300 + i}) 555-{1000 + i} phone or mail to user{i}@mail{i % 3}.example.com now") for i in range(60)]
    rows += [(100 + i, f"please call phone ({310 + i}) 555-{2000 + i} today") for i in range(20)]
    rows += [(200 + i, f"order id/{410 + i}.555.{3000 + i}/x") for i in range(20)]
    got = {r.doc_id: r for r in pii.detect(docs_of(*rows)).collect()}
    assert all(len(got[i].base) == 2 and len(got[i].spans) >= 2 for i in range(60))
    assert all(len(got[100 + i].spans) == 1 and not got[100 + i].base for i in range(20))
    assert not any(got[200 + i].spans for i in range(20))
    hidden = docs_of(rows[60]).join(spark.createDataFrame([got[100]], pii.detect(docs_of(rows[60])).schema), "doc_id")
    assert hidden.select(pii.masked(F.col("text"), F.col("spans")).alias("m")).first().m == "please call phone [phone] today"


def test_em_tells_good_labelers_from_bad():
    counts = {(3, (1, 1, 1, v, 1), 1, 0): 100 for v in (-1, 0, 1)} | {(3, (-1, -1, -1, v, -1), 1, 0): 100 for v in (-1, 0, 1)}
    model = pii.estimate(counts)
    assert model.reliability[3, 1, 1, 1] > 0.9 and model.reliability[3, 1, 0, -1] > 0.9
    assert abs(model.reliability[3, 3, 1, 1] - model.reliability[3, 3, 0, 1]) < 0.1


def test_empty_table_and_native_plan(docs_of):
    found = pii.detect(docs_of())
    assert found.count() == 0
    plan = pii.detect(docs_of((1, "a@b.c")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    digest = pii.detect(docs_of((1, "x"))).select(F.sha2(pii.as_text(F.col("base")), 256)).first()[0]
    assert digest == hashlib.sha256(b"").hexdigest()
