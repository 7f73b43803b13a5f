from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urndraw.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.findall("[0-9]", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("a1.@2 -+(0)é%9"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == slow_base(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "@x.y", "1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (168) 555-5254", "255", ".", " ", "0", "é", "@", "+"]), max_size=12))
def test_base_spans_of_parts(parts):
    assert pii.base_spans("".join(parts)) == slow_base("".join(parts))


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 300_000 + "." + "a" * 300_000 + "@" + "+" * 100_000) == []
    text = "b" * 200_000 + "@x.yz"
    assert pii.base_spans(text) == [("email", 0, len(text))]


EXAMPLES = [
    (f"{word} {span} end", [(kind, len(word) + 1, len(word) + 1 + len(span))])
    for word, (kind, span) in itertools.product(["call", "see", "from the", "x"], [
        ("phone", "+1 (168) 555-5254"), ("phone", "(168) 555-5254"), ("phone", "168-555-5254"), ("card", "4111 1111 1111 1111"),
        ("ip", "10.20.30.40"), ("email", "joe.doe@mail.example.com")])
] + [(f"{w} {x} end", []) for w, x in itertools.product(["on", "the"], ["2024-05-12", "12345678", "4111 1111 1111 1112", "7.25 or 1999"])]


def model():
    return pii.SemiCrf().fit(EXAMPLES)


def paths(crf, lattice):
    """All labellings with their scores."""
    n, scores = len(lattice.offsets) - 1, crf.scores(lattice)
    starts = {}
    for i, (a, b) in enumerate(lattice.spans):
        starts.setdefault(a, []).append((i, b))

    def walk(at, label):
        if at == n:
            yield 0.0, ()
            return
        for value, rest in walk(at + 1, 0):
            yield crf.moves[label, 0] + value, rest
        for i, stop in starts.get(at, []):
            for k in range(len(pii.KINDS)):
                for value, rest in walk(stop, k + 1):
                    yield crf.moves[label, k + 1] + scores[i, k] + value, ((pii.KINDS[k], lattice.offsets[at], lattice.offsets[stop]), *rest)

    return list(walk(0, 0))


def test_sums_and_best_path_equal_all_paths():
    crf = model()
    for text in ["a 168-555-5254", "10.20.30.40", "x (168) 555", "1234 5678"]:
        lattice = crf.lattice(text)
        every = paths(crf, lattice)
        ahead, _, back, _ = crf._sums(lattice)
        total = np.logaddexp.reduce([v for v, _ in every])
        assert np.isclose(np.logaddexp.reduce(ahead[-1]), total) and np.isclose(back[0, 0], total)
        assert crf.decode(text, [], margin=0) == list(max(every)[1])


def test_adds_spans_and_keeps_base_ones():
    crf = model()
    text = "from the (411) 555-1507 end"
    assert pii.search(text, crf) == ([], [("phone", 9, 23)])
    assert pii.search("on 2023-01-02 end", crf) == ([], [])
    text = "see +1 (168) 555-5254 end, call 411-555-1507 end"
    base, spans = pii.search(text, crf)
    assert base == [("phone", 4, 21)] and spans == [("phone", 4, 21), ("phone", 32, 44)]
    assert pii.redact(text, spans) == "see <PHONE> end, call <PHONE> end"


ROWS = [(1, None), (2, ""), (3, "joe@a.bc and 1.2.3.4"), (3, "joe@a.bc and 1.2.3.4"), (None, "+1 (168) 555-5254"), (4, "é" * 50_000 + " 1.2.3.4")]


def test_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("spans", F.lit("own")).withColumn("key", F.lit(0))
    crf = pii.train(docs)
    got = pii.find(docs, crf).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, [tuple(s) for s in r.base]) for r in got) == sorted(
        (d is None, d or 0, slow_base(t or "")) for d, t in ROWS)
    clean = pii.redacted(docs, crf)
    assert clean.schema == docs.schema and {r.text for r in clean.where("doc_id = 3").collect()} == {"<EMAIL> and <IP>"}
    assert clean.where("doc_id = 1").first().text is None
    none = docs.limit(0)
    assert pii.find(none, pii.train(none)).count() == 0


def test_query_equals_the_patterns(spark):
    from urndraw.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op7_pii"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = slow_base(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_spans_across_the_blocks_of_a_long_region():
    class Finds:
        """Says that each run of x is a phone, wherever a block puts it."""

        names = ["phone"]

        def decode(self, text, blocked):
            import re

            return [("phone", m.start(), m.end()) for m in re.finditer("x+", text)]

    for at in (19_980, 19_996, 20_000, 20_004, 39_999):
        text = "1" * at + "x" * 9 + "1" * (60_000 - at)
        assert [s for s in pii.search(text, Finds())[1] if s[0] == "phone"] == [("phone", at, at + 9)]
