from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from urndraw.llm import passages


def slow_units(text, every, least):
    """(normalised unit, start, end, words) one line after another."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        words = [(m[0].lower(), at + m.start(), at + m.end()) for m in re.finditer(r"[^\W_]+", line)]
        unit = []
        for i, w in enumerate(words):
            unit.append(w)
            if xxhash.xxh64_intdigest(w[0].encode(), 7) % every == 0 or i == len(words) - 1:
                if len(unit) >= least:
                    out.append((" ".join(x[0] for x in unit), unit[0][1], unit[-1][2], len(unit)))
                unit = []
        at += len(line) + 1
    return out


def slow(docs, every=6, least=4, passage=20):
    seen, out = {}, []
    for d, text in sorted(set(docs), key=lambda r: (r[0] is not None, r[0])):
        units = slow_units(text, every, least)
        marked = []
        for at, (u, *_) in enumerate(units):
            if u in seen:
                marked.append(at)
            seen.setdefault(u, (d, at))
        cuts, run = [], []
        for at in [*marked, -9]:
            if run and at != run[-1] + 1:
                if sum(units[i][3] for i in run) >= passage:
                    cuts.append((units[run[0]][1], units[run[-1]][2]))
                run = []
            run.append(at)
        kept = text
        for a, b in reversed(cuts):
            kept = kept[:a] + kept[b:]
        out += [(d, kept, cuts)] * docs.count((d, text))
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join(rng.choice(["tree", "House", "line,", "of", "the", "é", "sea.", "und"]) + str(rng.randrange(90)) for _ in range(n))


def test_equals_brute_force(spark):
    rng = random.Random(2)
    shared = [prose(rng, 70) for _ in range(6)]
    docs = [(0, None), (1, ""), (2, "..."), (3, shared[0]), (3, shared[0]), (None, shared[1]), (4, prose(rng, 30_000))]
    docs += [(d, prose(rng, rng.randint(0, 60)) + rng.choice([" ", "\n", "\n\n"]) + rng.choice(shared) + " " + prose(rng, rng.randint(0, 40))) for d in range(5, 90)]
    docs += [(d, shared[2]) for d in range(90, 130)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("removed", F.lit("own")).withColumn("digest", F.lit(1)).withColumn("at", F.lit(1))
    got = passages.dedup_passages(table).collect()
    assert sorted(((r.doc_id, r.text, [tuple(s) for s in r.removed]) for r in got), key=str) == slow(docs)
    for r in got:
        at = 0
        for a, b in sorted([tuple(s) for s in r.removed] + [tuple(s) for s in r.kept]):
            assert a == at
            at = b


def test_passages_of_fifty_words_are_caught_wherever_they_start(spark):
    rng = random.Random(3)
    docs = []
    for k in range(100):
        passage = prose(rng, 51)
        docs += [(2 * k, prose(rng, 30) + " " + passage + " " + prose(rng, 9)), (2 * k + 1, prose(rng, 7) + " " + passage + "\n" + prose(rng, 25))]
    docs += [(d, prose(rng, 200)) for d in range(200, 300)]
    got = {r.doc_id: len(r.removed) for r in passages.dedup_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(got[d] > 0 for d in range(1, 200, 2)) >= 97
    assert not any(got[d] for d in [*range(0, 200, 2), *range(200, 300)])


def test_empty_table(spark):
    assert passages.dedup_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
