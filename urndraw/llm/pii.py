"""Personal data: four base patterns, and a semi-Markov conditional random field that adds what they miss.

The field scores whole spans: their shape, digits, separators, checksum and surroundings. Dynamic programming over the
tokens around a digit or an at sign chooses boundaries and kinds together; a span has at most ``MOST_TOKENS`` tokens and
all else is outside, one token at a time. Spans of the base patterns always stay, and added ones never touch them.

The weights are fitted to the base spans of a bounded number of regions (``REGIONS``, chosen by a hash of id and text) and
to the same regions with the spans rewritten in spellings the patterns do not accept (a national phone number, a card number
in dotted groups, a spelled-out at sign). Offsets count code points, ends are exclusive.

Defined cases: null text counts as empty; rows that repeat are searched each on its own; null ids are kept; without any
region to learn from only the base spans are returned. Base patterns are searched in linear time, also in one long run of
digits or letters.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import hashed_share, text_or_empty

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 14
FEATURES = 12
REGIONS = 400
EPOCHS = 12
#: Log odds an added span must have over leaving its tokens outside.
MARGIN = 2.0
#: Characters of context on either side of an anchor, and tokens whose spans are scored together.
CONTEXT, BLOCK = 40, 2000
#: Characters that a block of a long region sees on either side of its own.
AROUND = 2000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits gives the same outcome from any of its digits, so it is tried once, from its first
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_anchor = re.compile(r"[0-9@]|[\[(]at[\])]")
_token = re.compile(r"[^\W_]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _domain.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind as listed and then start."""
    found = [("email", *span) for span in _emails(text)]
    if _digit.search(text):
        for m in _ip.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _card.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _phone.finditer(text):
            if 8 <= len(_digit.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around anchors, which do not overlap."""
    out: list[list[int]] = []
    for m in _anchor.finditer(text):
        start, end = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _class_of(token: str) -> str:
    if token.isspace():
        return " "
    if token.isdigit():
        return "9"
    if token.isalnum():
        return "a" if token.isalpha() else "x"
    return token


def _shape(tokens: list[str]) -> str:
    return "".join(_class_of(t) + (str(min(len(t), 5)) if t.isdigit() else "") for t in tokens)


def span_features(tokens: list[str], start: int, stop: int, text: str) -> list[str]:
    """Whole-span features, always the same number of them."""
    inside = tokens[start:stop]
    digits = "".join(c for c in text if "0" <= c <= "9")
    groups = text.split(".")
    before = tokens[start - 1] if start else ""
    before2 = tokens[start - 2] if start > 1 and before.isspace() else before
    after = tokens[stop] if stop < len(tokens) else ""
    after2 = tokens[stop + 1] if stop + 1 < len(tokens) else ""
    quad = len(groups) == 4 and all(g.isdigit() and len(g) < 4 and int(g) <= 255 for g in groups)
    kinds = sorted({_class_of(t) for t in inside})
    return [
        "shape " + _shape(inside), "outline " + "".join(map(_class_of, inside)), f"digits {min(len(digits), 20)}",
        f"tokens {len(inside)}", "kinds " + "".join(kinds), f"at {text.count('@')} {'at' in [t.lower() for t in inside]}",
        f"luhn {13 <= len(digits) <= 19 and luhn(digits)} {len(digits)}", f"quad {quad}",
        f"first {_class_of(inside[0])} last {_class_of(inside[-1])} {min(len(inside[-1]), 7)}",
        "before " + _class_of(before or "^") + _class_of(before2 or "^"), "after " + _class_of(after or "$") + _class_of(after2 or "$"),
        f"parens {text.count('(')}{text.count(')')}",
    ]


@dataclass
class Lattice:
    """A region's tokens and its candidate spans, in order of their ends."""
    offsets: list[int]
    spans: list[tuple[int, int]]
    features: np.ndarray


@dataclass
class SemiCrf:
    names: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, len(KINDS))))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS) + 1, len(KINDS) + 1)))

    def lattice(self, text: str, blocked: list[tuple[int, int]] = (), learn: bool = False) -> Lattice:
        tokens = _token.findall(text)
        offsets = np.r_[0, np.cumsum([len(t) for t in tokens], dtype=np.int64)].tolist()
        digits = np.r_[0, np.cumsum([sum("0" <= c <= "9" for c in t) for t in tokens], dtype=np.int64)].tolist()
        ats = np.r_[0, np.cumsum([t == "@" or t == "at" for t in tokens], dtype=np.int64)].tolist()
        shut = np.zeros(len(text) + 1, np.int64)
        for a, b in blocked:
            shut[max(a, 0):max(b, 0)] = 1
        shut = np.r_[0, np.cumsum(shut)].tolist()
        opens = [t in "+([" or t[0].isalnum() for t in tokens]
        closes = [t == ")" or t[0].isalnum() for t in tokens]
        spans, rows = [], []
        for stop in range(1, len(tokens) + 1):
            if not closes[stop - 1]:
                continue
            for start in range(max(0, stop - MOST_TOKENS), stop):
                if opens[start] and (digits[stop] - digits[start] >= 4 or ats[stop] > ats[start]) \
                        and shut[offsets[stop]] == shut[offsets[start]]:
                    spans.append((start, stop))
                    rows.append([self._name(f, learn) for f in span_features(tokens, start, stop, text[offsets[start]:offsets[stop]])])
        return Lattice(offsets, spans, np.array(rows, np.int64).reshape(len(rows), FEATURES))

    def _name(self, feature: str, learn: bool) -> int:
        if learn:
            return self.names.setdefault(feature, len(self.names) + 1)
        return self.names.get(feature, 0)

    def scores(self, lattice: Lattice) -> np.ndarray:
        return self.weights[lattice.features].sum(axis=1) if len(lattice.spans) else np.zeros((0, len(KINDS)))

    def _sums(self, lattice: Lattice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums by (place, label), and the scores of spans by label."""
        n, scores = len(lattice.offsets) - 1, self.scores(lattice)
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        for i, (a, b) in enumerate(lattice.spans):
            ends[b].append(i)
            starts[a].append(i)
        ahead = np.full((n + 1, len(KINDS) + 1), -np.inf)
        ahead[0, 0] = 0
        enter = np.full((n + 1, len(KINDS) + 1), -np.inf)  # sums at a place, before the next label's move is scored
        for at in range(n + 1):
            if at:
                outside = enter[at - 1, 0]
                ahead[at, 0] = outside
                for i in ends[at]:
                    ahead[at, 1:] = np.logaddexp(ahead[at, 1:], scores[i] + enter[lattice.spans[i][0], 1:])
            enter[at] = np.logaddexp.reduce(ahead[at][:, None] + self.moves, axis=0)
        back = np.full((n + 1, len(KINDS) + 1), -np.inf)
        back[n] = 0
        for at in range(n - 1, -1, -1):
            leave = np.full(len(KINDS) + 1, -np.inf)  # by the label that starts here
            leave[0] = back[at + 1, 0]
            for i in starts[at]:
                leave[1:] = np.logaddexp(leave[1:], scores[i] + back[lattice.spans[i][1], 1:])
            back[at] = np.logaddexp.reduce(self.moves + leave[None, :], axis=1)
        return ahead, enter, back, scores

    def fit(self, examples: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5,
            shrink: float = 1e-3) -> SemiCrf:
        """Conditional likelihood by AdaGrad, one region after another; regions whose spans are no candidates are left out."""
        ready = []
        for text, gold in examples:
            lattice = self.lattice(text, learn=True)
            at = {o: i for i, o in enumerate(lattice.offsets)}
            index = {s: i for i, s in enumerate(lattice.spans)}
            true = [(index.get((at.get(a, -1), at.get(b, -1))), KINDS.index(kind)) for kind, a, b in gold]
            if lattice.spans and all(i is not None for i, _ in true):
                ready.append((lattice, sorted(true)))
        self.weights = np.zeros((len(self.names) + 1, len(KINDS)))
        squares, move_squares = np.full_like(self.weights, 1e-2), np.full_like(self.moves, 1e-2)
        for _ in range(epochs):
            for lattice, true in ready:
                ahead, enter, back, scores = self._sums(lattice)
                n = len(lattice.offsets) - 1
                norm = np.logaddexp.reduce(ahead[n])
                a = np.array([s for s, _ in lattice.spans])
                b = np.array([e for _, e in lattice.spans])
                share = -np.exp(scores + enter[a, 1:] + back[b, 1:] - norm)
                for i, kind in true:
                    share[i, kind] += 1
                # expected and true moves: into outside tokens and into spans
                move = np.zeros_like(self.moves)
                move[:, 0] -= np.exp(ahead[:n] + self.moves[:, 0] + back[1:, :1] - norm).sum(axis=0)
                for i, (s, e) in enumerate(lattice.spans):
                    move[:, 1:] -= np.exp(ahead[s][:, None] + self.moves[:, 1:] + scores[i] + back[e, 1:] - norm)
                path, place, label = {lattice.spans[i]: kind for i, kind in true}, 0, 0
                while place < n:
                    step = next(((s, e) for s, e in path if s == place), None)
                    new = path[step] + 1 if step else 0
                    move[label, new] += 1
                    place, label = (step[1] if step else place + 1), new
                grad = np.zeros((len(self.weights), len(KINDS)))
                np.add.at(grad, lattice.features.ravel(), np.repeat(share, lattice.features.shape[1], axis=0))
                touched = np.unique(lattice.features)
                g = grad[touched] - shrink * self.weights[touched]
                squares[touched] += g * g
                self.weights[touched] += rate * g / np.sqrt(squares[touched])
                move -= shrink * self.moves
                move_squares += move * move
                self.moves += rate * move / np.sqrt(move_squares)
        self.weights[0] = 0
        return self

    def decode(self, text: str, blocked: list[tuple[int, int]], margin: float = MARGIN) -> list[tuple[str, int, int]]:
        """The best labelling's spans, clear of the ``blocked`` ones."""
        lattice = self.lattice(text, blocked)
        if not lattice.spans:
            return []
        scores, n = self.scores(lattice) - margin, len(lattice.offsets) - 1
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        for i, (_, b) in enumerate(lattice.spans):
            ends[b].append(i)
        best = np.full((n + 1, len(KINDS) + 1), -np.inf)
        best[0, 0] = 0
        came: list[list] = [[None] * (len(KINDS) + 1) for _ in range(n + 1)]
        enter = np.zeros((n + 1, len(KINDS) + 1))
        source = np.zeros((n + 1, len(KINDS) + 1), np.int64)
        for at in range(n + 1):
            if at:
                best[at, 0], came[at][0] = enter[at - 1, 0], (at - 1, source[at - 1, 0])
                for i in ends[at]:
                    start = lattice.spans[i][0]
                    value = scores[i] + enter[start, 1:]
                    for k in np.flatnonzero(value > best[at, 1:]):
                        best[at, k + 1], came[at][k + 1] = value[k], (start, source[start, k + 1])
            moved = best[at][:, None] + self.moves
            source[at], enter[at] = moved.argmax(axis=0), moved.max(axis=0)
        found, at, label = [], n, int(best[n].argmax())
        while at:
            start, earlier = came[at][label]
            if label:
                found.append((KINDS[label - 1], lattice.offsets[start], lattice.offsets[at]))
            at, label = start, int(earlier)
        return found[::-1]


def rewritten(text: str, kind: str, start: int, end: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The region with one span in spellings that the base patterns do not accept."""
    span = text[start:end]
    digits = "".join(_digit.findall(span))
    other: list[str] = []
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        other = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    elif kind == "card":
        other = [".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    elif kind == "email":
        other = [span.replace("@", " [at] "), span.replace("@", " (at) ")]
    return [(text[:start] + o + text[end:], [(kind, start, start + len(o))]) for o in other]


def disjoint(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Leftmost, then longest."""
    out: list[tuple[str, int, int]] = []
    for span in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


def train(docs: DataFrame, most_regions: int = REGIONS, id_column: str = "doc_id", text_column: str = "text") -> SemiCrf:
    """Fit on at most ``most_regions`` regions; a region that the base patterns reject is an example of what to leave."""
    rows = docs.select(F.col(id_column).cast("string").alias("id"), text_or_empty(text_column).alias("text")).where(
        F.col("text").rlike("[0-9@]"))
    # one text in forty is expected to have an anchor at least; the limits below then hold exactly
    rows = rows.where(hashed_share(docs.count(), 40 * most_regions, "id", "text"))
    key = F.xxhash64("id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = base_spans(text)
                for i, (a, b) in enumerate(regions(text)):
                    if b - a <= 20 * CONTEXT and all(s >= b or e <= a or (s >= a and e <= b) for _, s, e in spans):
                        gold = disjoint([(k, s - a, e - a) for k, s, e in spans if s >= a and e <= b])
                        out.append((key, i, text[a:b], json.dumps(gold)))
            key, i, text, gold = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(i, pa.int64()), pa.array(text, pa.string()), pa.array(gold, pa.string())],
                ["key", "i", "text", "gold"])

    # the texts with the smallest hashes; a region with spans and one without count alike
    chosen = rows.select(key.alias("key"), "text").orderBy("key").limit(most_regions)
    cuts = chosen.mapInArrow(cut, "key long, i long, text string, gold string").orderBy("key", "i").limit(most_regions).collect()
    examples = []
    for r in cuts:
        gold = [tuple(g) for g in json.loads(r["gold"])]
        examples.append((r["text"], gold))
        if len(gold) == 1:
            examples += rewritten(r["text"], *gold[0])
    return SemiCrf().fit(examples)


def search(text: str, model: SemiCrf | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed and then start."""
    base = base_spans(text)
    if model is None or not model.names or not _anchor.search(text):
        return base, base
    blocked = [(s, e) for _, s, e in base]
    added = []
    for a, b in regions(text):
        # a region longer than a block, one of digits alone, say: blocks see what is around them and keep the spans that start in them
        for at in range(a, b, 10 * BLOCK):
            low, high = max(a, at - AROUND), min(b, at + 10 * BLOCK + AROUND)
            near = [(max(s, low) - low, min(e, high) - low) for s, e in blocked if s < high and e > low]
            for kind, start, end in model.decode(text[low:high], near):
                if at <= low + start < at + 10 * BLOCK and low + start >= (added[-1][2] if added else 0):
                    added.append((kind, low + start, low + end))
    rank = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (rank[s[0]], s[1], s[2]))


def find(docs: DataFrame, model: SemiCrf | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end) for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = "doc_id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [search(t, sent.value) for t in batch.column(1).to_pylist()]
            listed = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], pa.list_(span)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *listed], ["doc_id", "base", "spans"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(run, schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of the first one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: SemiCrf | None, text_column: str = "text") -> DataFrame:
    """``docs`` with the spans in ``text_column`` replaced; null text stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else redact(t, search(t, sent.value)[1]) for t in batch.column(at).to_pylist()]
            columns = [c if i != at else pa.array(texts, pa.string()) for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    return docs.mapInArrow(run, docs.schema)
