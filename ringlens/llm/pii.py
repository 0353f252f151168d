"""Personal data: candidate spans judged by gradient boosted trees.

Base rules find e-mail addresses, IP addresses, card and phone numbers; their spans always stand. High-recall generators
propose further, overlapping spans. Boosted trees score a candidate that touches no base span by its format and its context; per kind a
threshold is calibrated on texts left out of the training, and candidates above it that touch no other span are added.

The trees are to find what the base rules miss, so their labels are not the base rules': confirmed spans, written in forms that the
base rules do not list and put in their own place, are positive; the same places with numbers and strings that are no personal data, and
candidates of the texts that fail checksum and range and have no context word, are negative. Other look-alikes have no label.

All scanning is one pass over a text: every pattern starts at a fixed character and none backtracks over a long run.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import only_columns, small_batches
from ringlens.plans.runtime import materialize

KINDS = ("email", "ip", "card", "phone")
TRAIN_TEXTS = 20_000  # texts with a digit or an at sign that are drawn for the training, about
TRAIN_CANDIDATES = 50_000  # candidates of them that the trees are trained and calibrated on, about
PRECISION = 0.99  # that a threshold has to reach on the left-out texts
CONTEXT = 32  # characters before a span that count as its context

_INTERESTING = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_EMAIL = re.compile(r"@[^\s@<>,;:()\[\]]+")
_LOOSE_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9])*")
_SPACED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\x20?\.\x20?)[0-9]{1,3}){3}(?![0-9])")
_COLON_IP = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_WORDS = {
    "email": re.compile(r"mail|contact|write", re.I), "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|account", re.I), "phone": re.compile(r"phone|call|\btel\b|mobile|fax", re.I),
}


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[0::2]) % 10 == -sum(sum(divmod(2 * v, 10)) for v in values[1::2]) % 10


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                yield start, m.end()
                done = m.end()
        at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        # a run of dotted numbers is matched four parts at a time from its first
        at, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the base rules' spans, sorted."""
    if not text or not _INTERESTING.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)] + [(a, 1, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """High-recall proposals (start, kind, end): anything around an at sign, and every number with its separators as a
    card, a phone number and, if dotted, an address, and groups of digits or hexadecimal digits with brackets, spaces or colons between them as
    an address. They overlap each other and the base spans."""
    out = set()
    done = 0
    for m in _LOOSE_EMAIL.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace() and text[start - 1] not in "<>,;:()[]@":
            start -= 1
        done = m.end()
        if start < m.start():
            out.add((start, 0, m.end()))
    for m in _LOOSE_NUMBER.finditer(text):
        n = sum(map(str.isdigit, m.group()))
        if 7 <= n <= 24:
            out.update({(m.start(), 2, m.end()), (m.start(), 3, m.end())})
        if n <= 12 and m.group().count(".") == 3:
            out.add((m.start(), 1, m.end()))
    out.update((m.start(), 1, m.end()) for m in _SPACED_IP.finditer(text))
    out.update((m.start(), 1, m.end()) for m in _COLON_IP.finditer(text) if any(map(str.isdigit, m.group())))
    out.update(base_spans(text))
    return sorted(out)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of a candidate."""
    start, kind, end = span
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    parts = [p for p in re.split(r"[^0-9]+", s) if p]
    before, after = text[start - 1 : start], text[end : end + 1]
    domain = s.partition("@")[2]
    groups = s.split(":")
    return [
        *[float(kind == k) for k in range(len(KINDS))], float(len(s)), float(len(digits)), len(digits) / len(s),
        float(s.startswith("+")), float(s.count(".")), float(len(parts)), float(max(map(len, parts), default=0)),
        float(0 < len(digits) <= 19 and luhn(digits)), float(bool(parts) and all(len(p) <= 3 and int(p) <= 255 for p in parts)),
        float("@" in s), float(domain.count(".")), float(len(domain.rpartition(".")[2])), float(s.isascii()),
        float(len(parts[0]) if parts else 0), float(len(parts[-1]) if parts else 0), float(before.isalnum()), float(after.isalnum()), float(bool(re.search(r"[()/]", s))),
        float(bool(_WORDS[KINDS[kind]].search(text, max(0, start - CONTEXT), start))),
        float(len(groups)), float(max(map(len, groups))), float("::" in s), float(s.count("[") + s.count("(")), float(s.count(" ")),
    ]


def rewritten(s: str, kind: int, draw: int) -> list[tuple[str, bool]]:
    """Forms of a confirmed span ``s`` that no base rule lists, and strings that resemble it and are clean; ``draw`` varies them."""
    digits = re.sub(r"[^0-9]", "", s)
    if KINDS[kind] == "email":
        local, _, domain = s.partition("@")
        odd = "äéöñüçøš"[draw % 8]
        short = ".".join(domain.split(".")[-2:])
        return [(f"{local[:-1]}{odd}@{domain}", True), (f"{local}@{odd}{domain}", True), (f"{local}@{odd}{short}", True), (f"{local}@{domain.replace('.', '')}", False), (f"{local}@{short.partition('.')[0]}", False)]
    if KINDS[kind] == "ip":
        a, b, c, d = (int(x) for x in s.split("."))
        high = 256 + draw % 700
        joints = ("[.]", "(.)", " . ", "[dot]")
        joint, other = joints[draw % 4], joints[draw // 4 % 4]
        mac = ":".join(f"{x:02x}" for x in (a, b, c, d, draw % 256, draw // 256 % 256))
        clock = f"{draw % 24:02d}:{a % 60:02d}:{b % 60:02d}"
        clean = (mac, clock, f"{2000 + a % 40}:{1 + b % 12:02d}:{1 + c % 28:02d}:{clock}", f"{a}:{b}:{c}", f"{c}:{d}:{a}:{b}")
        return [
            (joint.join(map(str, (a, b, c, d))), True), (f"2001:db8:{a:x}:{b:x}::{c:x}:{d:x}", True), (f"fe80::{a:x}{b:02x}:{c:x}{d:02x}", True),
            (":".join(f"{x:x}" for x in (0x2001, draw % 65536, a, b * 256 + c, d, draw // 7 % 65536, b, c * 256 + d)), True),
            (other.join(map(str, (a, high, c, d))), False), *[(clean[(draw + i) % len(clean)], False) for i in (0, 2)],
        ]
    if KINDS[kind] == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + draw % 9) % 10)
        sep = "./"[draw % 2]
        return [(sep.join(four), True), (sep.join([*four[:-1], wrong[-len(four[-1]) :]]), False), (wrong, False)]
    if KINDS[kind] == "phone":
        parts = re.findall(r"[0-9]+", s)
        if len(parts) < 3:
            parts = [digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]]
            parts = [x for x in parts if x]
        sep = ".-/ "[draw % 4]
        out = [(sep.join(parts), True)]
        if len(parts) > 3:
            out += [(sep.join(parts[1:]), True), (f"({parts[1]}) {'-. '[draw % 3].join(parts[2:])}", True)]
        threes = re.sub(r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ".-, "[draw % 4], digits[: 9 + draw % 4])
        date = f"{1950 + draw % 90}-{1 + draw % 12:02d}-{1 + draw % 28:02d}"
        clean = (digits, digits[:10], threes, f"{date} {draw % 24:02d}", f"{digits[:3]}.{digits[3:]}", f"{digits[:7]}.{digits[7:9]}", f"{date[:4]}-{date[:4]}/{digits[:4]}", f"a{digits}f")
        return out + [(clean[(draw + i) % len(clean)], False) for i in (0, 3, 5)]
    return []


def _fails(text: str, span: tuple[int, int, int]) -> bool:
    """Whether a candidate fails the checksum and the range of its kind and has no context word."""
    start, kind, end = span
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    if _WORDS[KINDS[kind]].search(text, max(0, start - CONTEXT), start):
        return False
    if KINDS[kind] == "email":
        return "." not in s.partition("@")[2]
    if KINDS[kind] == "ip" and ":" in s:
        return "::" not in s and s.count(":") != 7
    if KINDS[kind] == "ip":
        return any(len(p) > 3 or int(p) > 255 for p in re.findall(r"[0-9]+", s))
    if KINDS[kind] == "card":
        return not (12 <= len(digits) <= 19 and luhn(digits))
    return not 9 <= len(digits) <= 15


def labelled(text: str, draw: int) -> Iterator[tuple[list[float], float, int]]:
    """Features, label and place of the training candidates of a text, all of which touch no base span."""
    base = base_spans(text)
    cover = Cover(base)
    for c in candidates(text):
        if not cover.touches(c) and _fails(text, c):
            yield features(text, c), 0.0, c[0]
    for start, kind, end in base:
        left, right = text[max(0, start - 2 * CONTEXT) : start], text[end : end + 2 * CONTEXT]
        for form, good in rewritten(text[start:end], kind, (draw ^ start * 2654435761) % 1_000_003):
            a, b, t = len(left), len(left) + len(form), left + form + right
            known = Cover(base_spans(t))
            for c in candidates(t):
                if c[0] < b and c[2] > a and not known.touches(c):
                    same = (c[0], c[2]) == (a, b)
                    if not good or same:
                        yield features(t, c), float(good and c[1] == kind), start


class Trees:
    """Boosted trees as flat arrays, and the least score per kind (above 1: the kind adds nothing)."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], weights: list[float], least: list[float]):
        self.trees, self.weights, self.least = trees, weights, least

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for (feature, threshold, child, value), w in zip(self.trees, self.weights, strict=True):
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                right = x[np.arange(len(x)), np.maximum(feature[at], 0)] > threshold[at]
                at = np.where(inner, child[at] + right, at)
            total += w * value[at]
        return 1.0 / (1.0 + np.exp(-2.0 * total))

    def spans(self, text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """The base spans and all spans of a text, both sorted."""
        base = base_spans(text)
        if not text or min(self.least) > 1 or not _INTERESTING.search(text):
            return base, base
        cover = Cover(base)
        free = [c for c in candidates(text) if not cover.touches(c)]
        if not free:
            return base, base
        scores = self.score(np.array([features(text, c) for c in free]))
        added: list[tuple[int, int, int]] = []
        starts: list[int] = []  # of the added spans, in order; as they do not overlap, their ends are in order too
        ends: list[int] = []
        for s, c in sorted(zip(-scores, free, strict=True)):  # best first; ties by place and kind
            i = bisect_left(starts, c[2])
            if -s >= self.least[c[1]] and (i == 0 or ends[i - 1] <= c[0]):
                added.append(c)
                starts.insert(i, c[0])
                ends.insert(i, c[2])
        return base, sorted(base + added)


class Cover:
    """Spans in order of their starts, with the largest end so far: tells in one look whether another span overlaps any."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [a for a, _, _ in spans]
        self.ends = list(accumulate((b for _, _, b in spans), max))

    def touches(self, span: tuple[int, int, int]) -> bool:
        i = bisect_left(self.starts, span[2])
        return i > 0 and self.ends[i - 1] > span[0]


def _flat(tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A regression tree of Spark ML as arrays: feature (-1 for a leaf), threshold, left child (the right one follows), value."""
    feature, threshold, child, value = [], [], [], []
    queue = [tree._java_obj.rootNode()]
    for node in queue:
        value.append(node.prediction())
        if node.subtreeDepth():
            feature.append(node.split().featureIndex())
            threshold.append(node.split().threshold())
            child.append(len(queue))
            queue += [node.leftChild(), node.rightChild()]
        else:
            feature.append(-1)
            threshold.append(0.0)
            child.append(0)
    return np.array(feature), np.array(threshold), np.array(child), np.array(value)


def fit(docs: DataFrame, texts: int = TRAIN_TEXTS, most: int = TRAIN_CANDIDATES, precision: float = PRECISION) -> Trees:
    """Trees fitted on about ``texts`` different texts of (text) that have a digit or an at sign, drawn by a hash of the text.

    The labels are those of :func:`labelled`. A text counts once, however often the table has it, so the draw stays near its bound.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    eligible = small_batches(docs).select("text", F.xxhash64("text").alias("h")).filter(F.col("text").rlike("[0-9@]"))
    n = eligible.select("h").distinct().count()
    share = min(1.0, texts / max(n, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, text, place, part = [], [], [], [], []
            for t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for values, good, start in labelled(t, h % 1_000_003):
                    x.append(values)
                    y.append(good)
                    text.append(h)
                    place.append(start)
                    part.append(h % 4 == 0)
            arrays = [pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64()), pa.array(text, pa.int64()), pa.array(place, pa.int64()), pa.array(part, pa.bool_())]
            yield pa.record_batch(arrays, ["x", "label", "h", "place", "left_out"])

    once = eligible.filter(F.pmod(F.col("h"), F.lit(1 << 20)) < share * (1 << 20)).groupBy("h").agg(F.min("text").alias("text"))
    drawn = once.select("text", "h").mapInArrow(run, "x array<double>, label double, h long, place long, left_out boolean")
    drawn = materialize(drawn, "pii-candidates")
    share = min(1.0, most / max(drawn.count(), 1))
    rows = drawn.filter(F.pmod(F.xxhash64("h", "place"), F.lit(1 << 20)) < share * (1 << 20))
    test = rows.filter("left_out").toPandas()
    train = rows.filter("not left_out").select(array_to_vector("x").alias("features"), "label").coalesce(1)
    if train.select("label").distinct().count() < 2 or test.empty:
        return Trees([], [], [2.0] * len(KINDS))
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=12, maxDepth=3, seed=7).fit(train)
    trees = Trees([_flat(t) for t in model.trees], list(model.treeWeights), [2.0] * len(KINDS))
    x = np.stack(test["x"].to_numpy())
    score, label = trees.score(x), test["label"].to_numpy()
    for k in range(len(KINDS)):
        mine = x[:, k] == 1
        for least in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99):
            over = mine & (score >= least)
            if over.sum() >= 20 and label[over].mean() >= precision:
                trees.least[k] = least
                break
    return trees


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(df: DataFrame, trees: Trees, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``df`` with ``out_col``: struct of base and spans (kind:start:end by start and kind, comma-joined; code points, end
    exclusive) and redacted, the text with each span replaced by its kind in brackets. Null texts have no spans and stay null."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            base, spans, redacted = [], [], []
            for t in column.to_pylist():
                b, s = trees.spans(t)
                base.append(_listed(b))
                spans.append(_listed(s))
                redacted.append(_redact(t, s) if s else t)
            yield pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in (base, spans, redacted)], ["base", "spans", "redacted"])

    judge = F.arrow_udf(run, "base string, spans string, redacted string")
    return small_batches(df).withColumn(out_col, judge(F.col(f"`{text_col}`")))


def _redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for a, k, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The numbers count the spans of a kind in ``spans``. Null and empty texts have none, and the hash of the empty string.
    """
    docs = only_columns(documents, doc_id=id_col, text=text_col)
    out = find_pii(docs, fit(docs.select("text")))
    count = [F.regexp_count(F.concat(F.lit(","), "pii.spans"), F.lit(f",{name}:")).cast("long").alias(f"n_{name}") for name in KINDS]
    return out.select(
        "doc_id", *count,
        F.sha2("pii.base", 256).alias("base_sha256"), F.col("pii.spans").alias("spans"),
    )
