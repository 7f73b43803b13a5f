from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from urndraw.llm import linededup


def slow(docs, window):
    """Every window of filled lines against all earlier ones."""
    seen, out = set(), []
    for d, text in sorted(set(docs), key=lambda r: (r[0] is not None, r[0])):
        lines = (text or "").split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(linededup.BLANKS)]
        gone = set()
        for at in range(len(filled) - window + 1):
            key = tuple(lines[i].strip(linededup.BLANKS) for i in filled[at:at + window])
            if key in seen:
                gone.update(range(filled[at], filled[at + window - 1] + 1))
            seen.add(key)
        for at in filled:
            if window > 1 and len(lines[at].split()) >= 20:
                if ("long", lines[at].strip(linededup.BLANKS)) in seen:
                    gone.add(at)
                seen.add(("long", lines[at].strip(linededup.BLANKS)))
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out += [(d, kept, len(filled), sum(i in gone for i in filled))] * docs.count((d, text))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [1, 2, 3])
def test_equals_brute_force(spark, window):
    rng = random.Random(window)
    docs = [(0, None), (1, ""), (2, "\n \n\t\n"), (3, "a\n\nb"), (3, "a\n\nb"), (None, "a\nb\nnobody"), (4, "a\n b \n c"), (5, "x\ny\nx\ny\nx\ny")]
    docs += [(d, "\n".join(rng.choices(["a", "b", "c", "", "d ", "e"], k=rng.randint(1, 12)))) for d in range(6, 60)]
    docs += [(d, "shared one\nshared two\nshared three") for d in range(60, 90)] + [(90, "long\n" * 40_000)]
    line = " ".join(f"w{i}" for i in range(25))
    docs += [(d, f"own {d}\n  {line}\nalso {d}\n{line[:-4]}") for d in range(91, 95)] + [(95, line + "\n" + line), (96, " ".join(line.split()[:19]) * 1)]
    docs += [(97, " ".join(line.split()[:19]))]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_lines", F.lit("own")).withColumn("at", F.lit(1)).withColumn("starts", F.lit(2)).withColumn("__starts", F.lit(3)).withColumn("row", F.lit(4)).withColumn("version", F.lit(5))
    got = linededup.dedup_lines(table, window)
    assert got.columns == ["doc_id", "text", "at", "starts", "__starts", "row", "version", "n_lines", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=str) == slow(docs, window)


def test_each_window_has_its_smallest_line_as_fingerprint():
    rng = random.Random(1)
    for _ in range(200):
        text = "\n".join(rng.choices("abcdefgh", k=12))
        by = {}
        for least, place, _, at, _ in linededup.winnowed(text, 4):
            assert at <= place < at + 4
            by.setdefault(least, set()).add(place)
        assert len(linededup.winnowed(text, 4)) == 9


def test_empty_table(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
