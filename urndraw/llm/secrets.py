"""Secrets in text: candidates by pattern, false positives removed by a random forest.

Candidates are runs of 16 or more key characters with a digit or a change from lower to upper case. Each is described by its length,
its character classes and the transitions between them, how much of it dictionary words cover, the path it comes from and the
words beside it. The forest is trained on labelled findings: a table of findings with a label, or, where nobody has labelled any,
those that stand in an assignment to a credential's name (1) or that are numbers, digests or words by their surroundings (0); each
of these counts once with and once without its neighbours, so that the shape has to tell as well.

Everything is DataFrame functions and the JVM's forest. Candidates are found in one pass without a shuffle and stored. The
dictionary counts the whole table and has the words with a share of ``WORD_SHARE`` or more, so no more than ``1 / WORD_SHARE`` of
them however large the table; a table listed twice has the same ones. The training set is ``FINDINGS`` labelled findings.

Defined cases: null text has no candidates; rows that repeat give their findings each; null ids and null paths are kept; with labels
of one class alone no forest is trained and a finding is kept unless its own label is 0. Starts count code points from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urndraw.functions.once import with_once
from urndraw.llm.common import hashed_share, stored, text_or_empty

CANDIDATE = r"[A-Za-z0-9+/=_-]{16,}"
LIKELY = "[0-9]|[a-z][A-Z]"
CREDENTIAL = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)\w*"
DIGEST = r"(?i)\b(sha-?(1|224|256|384|512)|md5|crc(32)?|commit|checksum|digest|hash|uuid|guid|etag|integrity|fingerprint)\b"
ORDINARY_PATH = r"(?i)(test|example|sample|mock|fixture|demo|vendor|lock)"
ASSIGNED = r"""[=:]\s*["'`]?$"""
WORD_SHARE = 1 / 4000
FINDINGS = 4000
TREES, DEPTH, SEED = 30, 8, 17
FEATURES = ["f_length", "f_digits", "f_upper", "f_lower", "f_symbols", "f_transitions", "f_distinct", "f_hex", "f_number",
            "f_coverage", "f_longest_letters", "f_path", "f_credential", "f_digest", "f_assigned", "f_quoted", "f_words_left"]
NEIGHBOURS = ["f_path", "f_credential", "f_digest", "f_assigned", "f_quoted", "f_words_left"]


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str = "source") -> DataFrame:
    """(doc_id, path, start, candidate, left, right): one row per candidate, with up to three words to either side."""
    path = F.col(path_column).cast("string") if path_column in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), path.alias("path"), text_or_empty(text_column).alias("text"))
    rows = with_once(rows.where(F.col("text").rlike(LIKELY)), {"words": F.split("text", r"(?<=\s)")}).select("doc_id", "path", "words")

    def word(i: Column) -> Column:
        return F.get("words", i)

    def joined(*places: Column) -> Column:
        return F.concat_ws("", *[word(p) for p in places])

    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.length(word(i)) >= 16) & word(i).rlike(CANDIDATE))
    hits = F.transform(at, lambda i: F.struct(
        F.length(F.array_join(F.slice("words", 1, i), "")).alias("offset"), word(i).alias("word"),
        joined(i - 3, i - 2, i - 1).alias("before"), joined(i + 1, i + 2, i + 3).alias("after")))
    found = rows.select("doc_id", "path", F.explode(hits).alias("hit")).select("doc_id", "path", "hit.*")
    found = with_once(found, {"parts": F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), F.lit(1)), "gaps": F.split("word", CANDIDATE, -1)})
    found = found.select("*", F.posexplode("parts").alias("k", "candidate"))
    inner = F.length(F.concat(F.array_join(F.slice("gaps", 1, F.col("k") + 1), ""), F.array_join(F.slice("parts", 1, F.col("k")), "")))
    found = with_once(found, {"inner": inner}).where(F.col("candidate").rlike(LIKELY))
    return found.select(
        "doc_id", "path", (F.col("offset") + F.col("inner")).cast("long").alias("start"), "candidate",
        F.concat("before", F.substring("word", F.lit(1), F.col("inner"))).alias("left"),
        F.concat(F.expr("substring(word, inner + 1 + length(candidate))"), F.col("after")).alias("right"))


def dictionary(docs: DataFrame, share: float = WORD_SHARE, text_column: str = "text") -> list[str]:
    """Words of three to fifteen letters that are at least ``share`` of all such words of the table: never more than ``1 / share``.

    Every word of every row is counted; the counts are combined in each task before their shuffle and stored.
    """
    each = docs.select(F.explode(F.split(F.lower(text_or_empty(text_column)), r"[^\p{L}]+")).alias("word"))
    counts = stored(each.where(F.length("word").between(3, 15)).groupBy("word").count(), "dictionary")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return sorted(r["word"] for r in counts.where(F.col("count") >= share * total).select("word").collect())


def described(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the features of each candidate."""
    c, length = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / length

    runs = F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) >= 3)
    known = F.filter(runs, lambda w: F.array_contains(F.lit(words or [""]), w))
    covered = F.length(F.array_join(known, ""))
    flag = lambda condition: F.coalesce(condition.cast("double"), F.lit(0.0))
    left, right = F.col("left"), F.col("right")
    values = {
        "f_length": length.cast("double"), "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"), "f_lower": share("[a-z]"),
        "f_symbols": share("[+/=_-]"),
        "f_transitions": share("[0-9](?=[^0-9])|[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[+/=_-](?=[^+/=_-])"),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / length, "f_hex": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "f_number": flag(c.rlike("^[0-9=_/+-]+$")), "f_coverage": covered / length,
        "f_longest_letters": F.coalesce(F.array_max(F.transform(F.split(c, "[^A-Za-z]+"), F.length)), F.lit(0)).cast("double"),
        "f_path": flag(F.col("path").rlike(ORDINARY_PATH)), "f_credential": flag(left.rlike(CREDENTIAL)),
        "f_digest": flag(left.rlike(DIGEST)), "f_assigned": flag(left.rlike(ASSIGNED)),
        "f_quoted": flag(left.rlike("""["'`]$""") & right.rlike("""^["'`]""")),
        "f_words_left": F.size(F.filter(F.split(F.lower(left), r"[^\p{L}]+"), lambda w: F.array_contains(F.lit(words or [""]), w))).cast("double"),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def rule_label() -> Column:
    """1 or 0 where the surroundings or the characters settle it, else null."""
    varied = (F.col("f_number") == 0) & (F.col("f_distinct") * F.col("f_length") >= 8)
    real = F.col("left").rlike(CREDENTIAL + r"""\s*""" + ASSIGNED) & varied & (F.col("f_digest") == 0)
    false = (F.col("f_number") == 1) | (F.col("f_digest") == 1) | (F.col("f_coverage") >= 0.5)
    return F.when(real, 1.0).when(false, 0.0)


def train(labelled: DataFrame, findings: int = FINDINGS):
    """A forest from described findings with a ``label`` of 0 or 1, or None where one of the two is missing."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # as many of either label, those with the smallest hashes: one frequent kind does not crowd out the other
    key = F.xxhash64("candidate", "left", "start")
    rows = labelled.select("label", *FEATURES, key.alias("key"))
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    half = [rows.where((F.col("label") == label) & hashed_share(totals.get(label, 0), findings, "key")).orderBy("key", *FEATURES).limit(findings // 2)
            for label in (0.0, 1.0)]
    chosen = stored(half[0].unionAll(half[1]).drop("key"), "secrets")
    if chosen.select("label").distinct().count() < 2:
        return None
    bare = chosen.withColumns({name: F.lit(0.0) for name in NEIGHBOURS})
    both = chosen.unionByName(bare.select(*chosen.columns)).coalesce(1)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(both)


def judged(found: DataFrame, model) -> DataFrame:
    """Described findings with ``score``, the forest's share of votes for a secret, and ``kept``."""
    from pyspark.ml.functions import vector_to_array

    if model is None:
        score = F.when(rule_label() == 0, 0.0).otherwise(1.0)
        return found.withColumn("score", score).withColumn("kept", F.col("score") >= 0.5)
    out = model.transform(found).withColumn("score", F.round(F.element_at(vector_to_array("probability"), 2), 6))
    return out.drop("features", "rawPrediction", "probability", "prediction").withColumn("kept", F.col("score") >= 0.5)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text",
         path_column: str = "source") -> DataFrame:
    """(doc_id, path, start, candidate, left, right, features, score, kept) for every candidate."""
    found = stored(candidates(docs, id_column, text_column, path_column), "secrets")
    found = described(found, dictionary(docs, text_column=text_column))
    if labelled is None:
        labelled = found.withColumn("label", rule_label()).where("label is not null")
    return judged(found, train(labelled))
