from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from urndraw.llm import secrets


def slow_candidates(text):
    return [(m.start(), m[0]) for m in re.finditer(secrets.CANDIDATE, text or "") if re.search(secrets.LIKELY, m[0])]


def hexes(rng, n):
    return "".join(rng.choices("0123456789abcdef", k=n))


def corpus(n=400):
    rng = random.Random(3)
    prose = lambda k: " ".join(rng.choices("the tree and house sea line with king of this".split(), k=k))
    docs, truth = [], {}
    for d in range(n):
        kind = d % 5
        if kind == 0:
            secret = hexes(rng, 40)
            line, real = f'{rng.choice(["token", "api_key", "PASSWORD"])} = "{secret}"', True
        elif kind == 1:
            secret, real = "".join(rng.choices("0123456789", k=16)), False
            line = f"number {secret} is"
        elif kind == 2:
            secret, real = hexes(rng, 40), False
            line = f"commit {secret} fixed"
        elif kind == 3:
            secret, real = "tree-house-line-2024", False
            line = f"/the/{secret}"
        else:
            docs.append((d, prose(30), "src/main"))
            continue
        text = f"{prose(rng.randint(0, 20))} {line} {prose(rng.randint(0, 20))}"
        docs.append((d, text, "src/main"))
        truth[d] = real
    return docs, truth


def test_candidates_equal_the_pattern(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "x" * 15 + "1", "a=1234567890123456;b=abcdefABCDEF1234\n\nz", "é " * 30 + hexes(rng, 20) + "　" + hexes(rng, 30), "\t" + "1" * 200_000]
    texts += ["".join(rng.choices(list("ab1 -=é\n\"A"), k=200)).replace("a", "a1b2c3d4e5f6") for _ in range(40)]
    docs = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, words int")
    got = secrets.candidates(docs).collect()
    assert sorted((r.doc_id, r.start, r.candidate) for r in got) == sorted((i, *c) for i, t in enumerate(texts) for c in slow_candidates(t))
    for r in got:
        text = texts[r.doc_id]
        assert text[:r.start].endswith(r.left) and text[r.start + len(r.candidate):].startswith(r.right)


def test_forest_tells_held_out_findings(spark):
    docs, truth = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = secrets.described(secrets.candidates(table), secrets.dictionary(table))
    label = F.when(F.col("doc_id").isin([d for d, real in truth.items() if real]), 1.0).otherwise(0.0)
    labelled = found.withColumn("label", label)
    model = secrets.train(labelled.where("doc_id % 2 = 0"))
    got = secrets.judged(found.where("doc_id % 2 = 1"), model).collect()
    right = sum(r.kept == truth[r.doc_id] for r in got)
    assert len(got) == sum(d % 2 for d in truth) and right >= 0.95 * len(got)


def test_scan_with_rule_labels(spark):
    docs, truth = corpus()
    docs += [(900, None, None), (901, "", "x"), (None, 'secret = "' + "ab12cd34ef56" * 3 + '"', None), docs[0], docs[0]]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("score", F.lit("own")).withColumn("left", F.lit("own"))
    got = secrets.scan(table).collect()
    assert sum(r.kept == truth.get(r.doc_id, True) for r in got) >= 0.95 * len(got)
    assert sum(r.doc_id == 0 for r in got) == 3 and any(r.doc_id is None and r.kept for r in got)
    assert secrets.scan(table.limit(0)).count() == 0
    one_class = secrets.scan(spark.createDataFrame([(1, "number 1234567890123456", "x")], "doc_id long, text string, source string")).first()
    assert not one_class.kept


def test_dictionary_counts_the_whole_table(spark):
    from collections import Counter

    rng = random.Random(11)
    vocabulary = ["w" + "".join(rng.choices("abcdefgh", k=rng.randint(1, 16))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(3000)], k=40)) for _ in range(300)]
    texts += ["Späte " * 200, "spät" * 5, "ab 12", "", None, "x" * 100_000]  # the frequent word of the last rows is in one row only
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, word int")
    counts = Counter(w for t in texts for w in re.split(r"[\W\d_]+", (t or "").lower()) if 3 <= len(w) <= 15)
    total = sum(counts.values())
    for share in (1 / 50, 1 / 1000):
        want = sorted(w for w, n in counts.items() if n >= share * total)
        assert secrets.dictionary(docs, share) == want and len(want) <= 1 / share
        assert secrets.dictionary(docs.unionAll(docs).repartition(7), share) == want
    assert "späte" in secrets.dictionary(docs, 1 / 100)
    assert secrets.dictionary(docs.limit(0)) == []


def test_query_finds_every_candidate(spark):
    from urndraw.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op2_secrets"](spark, "/root/testdata/sf0.01").collect()
    want = {(d, s, hashlib.sha256(c.encode()).hexdigest()) for d, t in texts.items() for s, c in slow_candidates(t)}
    assert {(r.doc_id, r.start, r.sha256) for r in got} == want and len(got) == len(want)
    for r in got:
        quoted = texts[r.doc_id][:r.start].lower().endswith('token = "')
        assert r.kept == quoted
