"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what the patterns miss.

Tokens that hold a digit or "@" are the field's nodes; all other tokens are fixed as no entity, which cuts the chain there and
leaves inference as it was. Neighbouring nodes share a potential, and so does each node with the next one in its document of the same
text (repeated) and the next one of the same shape (similar), however far away. Sum-product messages pass round these loops until
labels agree. Unary weights and potentials are fitted piecewise, on the pattern matches of a bounded sample of texts.

Cases: a null or empty text has no spans, and masking leaves it as it is. Long texts are read whole; every pattern is searched in
linear time. Repeated rows get the same spans. Only the text column is read, whatever other columns are called. Without a single
pattern match in the sample the field labels nothing, and the pattern spans remain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ontime.llm.tables import hash_sample

#: Fixed order of kinds.
KINDS = ("email", "ip", "card", "phone")
_ORDER = {k: i for i, k in enumerate(KINDS)}
LABELS = 1 + len(KINDS)

#: Largest number of texts that fit() reads.
FIT_ROWS = 2000

_HINT = re.compile(r"[0-9@]")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> list[Span]:
    """The local part is the run of its characters that ends at the "@", so each is found backwards, without rescanning."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        begin = free + len(local.rstrip(_LOCAL))
        match = _AT.match(text, at) if begin < at else None
        free = at + 1
        if match:
            found.append(("email", begin, match.end()))
            free = match.end()
        at = text.find("@", free)
    return found


def _ips(text: str) -> list[Span]:
    """Runs of dotted numbers, taken four at a time from the left."""
    found = []
    for run in _DOTTED.finditer(text):
        parts, at = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append(("ip", at, at + size))
            at += size + 1
    return found


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: code points, end exclusive, by kind and then start."""
    found = _emails(text) + _ips(text)
    for m in _CARD.finditer(text):
        if 13 <= len(m[0]) and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


# ---- the field ---------------------------------------------------------------------------------

_BLANKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})
_NODE = re.compile(r"[0-9@][^ ]*")
_EDGE_MARKS = ".,;:!?\"'"
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"[0-9]")
#: Kinds of edges.
CHAIN, REPEATED, SIMILAR = 0, 1, 2
FEATURES = 22


@dataclass
class Graph:
    """The nodes of one text and the edges between them."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    edges: np.ndarray


def _features(token: str, before: bool, after: bool, last: str) -> list[bool]:
    digits = len(_DIGITS.findall(token))
    core = token.strip(_EDGE_MARKS)
    only = digits > 0 and digits == len(core)
    return [
        True, "@" in token, "@" in token and "." in token[token.find("@") :], core.count(".") == 3, core.replace(".", "").isdigit(),
        core.startswith("+"), "(" in token or ")" in token, "-" in core, _LETTERS.search(token) is not None, "=" in token or '"' in token,
        digits == 0, digits == 1, 2 <= digits <= 3, digits == 4, 5 <= digits <= 8, 9 <= digits <= 12, only and 13 <= digits <= 19, only and 13 <= digits <= 19 and luhn(core), digits >= 20,
        before and last.startswith("+"), before and last.endswith(")"), before or after,
    ]


def graph(text: str) -> Graph:
    plain = text.translate(_BLANKS)
    spans, cores, rows, edges, seen = [], [], [], [], {}
    for m in _NODE.finditer(plain):
        left = spans[-1][1] if spans else 0
        begin = max(left, plain.rfind(" ", left, m.start()) + 1)
        spans.append((begin, m.end()))
    joined = [not plain[a[1] : b[0]].strip(" ") for a, b in zip(spans, spans[1:])]
    last = ""
    for i, (a, b) in enumerate(spans):
        token = plain[a:b]
        before, after = i > 0 and joined[i - 1], i < len(joined) and joined[i]
        rows.append(_features(token, before, after, last))
        last = token
        core = token.strip(_EDGE_MARKS).lower()
        cores.append(core)
        if before:
            edges.append((i - 1, i, CHAIN))
        for kind, key in ((REPEATED, core), (SIMILAR, _LETTERS.sub("a", _DIGITS.sub("9", core)))):
            if (j := seen.get((kind, key))) is not None and not (kind == SIMILAR and cores[j] == core):
                edges.append((j, i, kind))
            seen[kind, key] = i
    return Graph(spans, np.array(rows, np.float64).reshape(-1, FEATURES), np.array(edges, np.int64).reshape(-1, 3))


def _labels(found: Graph, spans: list[Span]) -> np.ndarray:
    """Of each node, the kind of the pattern span it overlaps, else 0."""
    out = np.zeros(len(found.spans), np.int64)
    ends = np.array([b for _, b in found.spans])
    for kind, a, b in reversed(spans):
        i = int(np.searchsorted(ends, a, side="right"))
        while i < len(out) and found.spans[i][0] < b:
            out[i] = 1 + _ORDER[kind]
            i += 1
    return out


@dataclass
class Model:
    """unary: features x labels; potentials: edge kinds x labels x labels, both as logarithms."""

    unary: np.ndarray
    potentials: np.ndarray


def _train(features: np.ndarray, labels: np.ndarray, edges: np.ndarray, rounds: int = 400, rate: float = 1.0) -> Model:
    """Piecewise: a softmax regression for the nodes, and the smoothed log ratio of joint to independent counts for the edges."""
    unary = np.zeros((FEATURES, LABELS))
    unary[0, 0] = 1.0
    known = np.eye(LABELS)[labels]
    if len(labels) and labels.any():
        for _ in range(rounds):
            score = features @ unary
            share = np.exp(score - score.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            unary += rate * (features.T @ (known - share) / len(labels) - 1e-4 * unary)
    prior = (known.sum(0) + 1) / (len(labels) + LABELS)
    potentials = np.zeros((3, LABELS, LABELS))
    for kind in range(3):
        a, b = edges[edges[:, 2] == kind, 0], edges[edges[:, 2] == kind, 1]
        # Ten counts go before the sample's: of independent labels on the chain, mostly of equal ones for alike tokens.
        joint = 10 * np.outer(prior, prior)
        if kind != CHAIN:
            joint = 0.2 * joint + 8 * np.diag(prior)
        np.add.at(joint, (labels[a], labels[b]), 1.0)
        if kind != CHAIN:
            joint = (joint + joint.T) / 2
        joint /= joint.sum()
        potentials[kind] = np.clip(np.log(joint / np.outer(joint.sum(1), joint.sum(0))), -3, 3)
    return Model(unary, potentials)


def _sum_product(scores: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = 15, damping: float = 0.5) -> np.ndarray:
    """Label of each node after passing messages along every edge, both ways."""
    if not len(edges):
        return scores.argmax(1)
    source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
    between = np.concatenate((potentials[edges[:, 2]], potentials[edges[:, 2]].transpose(0, 2, 1)))
    back = np.roll(np.arange(len(source)), len(edges))
    messages = np.zeros((len(source), LABELS))
    for _ in range(rounds + 1):
        belief = scores.copy()
        np.add.at(belief, target, messages)
        out = (belief[source] - messages[back])[:, :, None] + between
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        messages = damping * messages + (1 - damping) * (new - new.max(1, keepdims=True))
    return belief.argmax(1)


def field_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Runs of neighbouring nodes with one label, where no pattern matched."""
    found = graph(text)
    if not found.spans:
        return []
    labels = _sum_product(found.features @ model.unary, found.edges, model.potentials)
    joined = np.zeros(len(labels), bool)
    joined[found.edges[found.edges[:, 2] == CHAIN, 1]] = True
    taken = sorted((a, b) for _, a, b in base)
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    out, i = [], 0
    while i < len(labels):
        j = i + 1
        while j < len(labels) and joined[j] and labels[j] == labels[i]:
            j += 1
        if labels[i]:
            a, b = found.spans[i][0], found.spans[j - 1][1]
            piece = text[a:b]
            a, b = a + len(piece) - len(piece.lstrip(_EDGE_MARKS)), b - len(piece) + len(piece.rstrip(_EDGE_MARKS))
            earlier = int(np.searchsorted([x for x, _ in taken], b, side="left"))
            if a < b and not (earlier and reach[earlier - 1] > a):
                out.append((KINDS[labels[i] - 1], a, b))
        i = j
    return out


def find(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """Pattern spans, and these with the field's, each by kind and start."""
    if not text or not _HINT.search(text):
        return [], []
    base = pattern_spans(text)
    return base, sorted(base + field_spans(text, base, model), key=lambda s: (_ORDER[s[0]], s[1], s[2]))


# ---- on Spark ----------------------------------------------------------------------------------

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_ARROW_FOUND = pa.struct([("base", pa.list_(_ARROW_SPAN)), ("spans", pa.list_(_ARROW_SPAN))])


def fit(df: DataFrame, text: str = "text", max_rows: int = FIT_ROWS) -> Model:
    """Train on at most max_rows distinct texts that hold a digit or "@", picked by hash.

    The driver gets their nodes and edges, not their texts.
    """

    layout = pa.schema([("features", pa.binary()), ("labels", pa.list_(pa.int64())), ("edges", pa.list_(pa.int64()))])

    def nodes(batches):
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found = graph(value)
                labels = _labels(found, pattern_spans(value))
                packed = np.packbits(found.features.astype(bool), axis=1).tobytes()
                yield pa.RecordBatch.from_pylist([{"features": packed, "labels": labels.tolist(), "edges": found.edges.ravel().tolist()}], layout)

    column = F.col(f"`{text}`")
    sample = hash_sample(df.select(column.alias("t")).where(F.col("t").rlike("[0-9@]")), F.col("t"), max_rows)
    rows = sample.mapInArrow(nodes, "features binary, labels array<long>, edges array<long>").collect()
    features, labels, edges, n = [np.zeros((0, FEATURES))], [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)], 0
    width = (FEATURES + 7) // 8
    for r in rows:
        features.append(np.unpackbits(np.frombuffer(r.features, np.uint8).reshape(-1, width), axis=1)[:, :FEATURES].astype(np.float64))
        labels.append(np.array(r.labels, np.int64))
        edges.append(np.array(r.edges, np.int64).reshape(-1, 3) + [n, n, 0])
        n += len(r.labels)
    return _train(np.concatenate(features), np.concatenate(labels), np.concatenate(edges))


def annotate(text: str | Column, model: Model) -> Column:
    """A struct of base (pattern spans) and spans (these and the field's)."""

    def annotated(texts: pa.Array) -> pa.Array:
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        pairs = (find(t.as_py(), model) for t in texts)
        return pa.array([{"base": named(base), "spans": named(spans)} for base, spans in pairs], _ARROW_FOUND)

    return F.arrow_udf(annotated, FOUND).asNondeterministic()(text)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, as its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The table with personal data in its texts masked; all columns and rows stay."""

    def cleaned(texts: pa.Array) -> pa.Array:
        values = (t.as_py() for t in texts)
        return pa.array([v if not v else masked(v, find(v, model)[1]) for v in values], pa.string())

    column = F.arrow_udf(cleaned, T.StringType()).asNondeterministic()(F.col(f"`{text}`"))
    return df.withColumn(text, column)
