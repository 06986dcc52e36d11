"""Personal data: high-recall generators, boosted trees, calibrated thresholds.

Generators propose overlapping spans of four kinds (email, ip, card, phone): those of the
base rules, which always stay, and looser forms (written-out addresses, other separators,
digits of other scripts, numbers without a country code). Loose candidates that a check
refutes (Luhn's, a part over 255, digits of another kind's base span, calendar dates, pieces of
longer numbers, web sites, ends of sentences) are never added. Gradient-boosted trees score the others by format and
context features; the checks are no features. They learn from a bounded sample of
documents, and only from candidates with a verifiable label: base spans and base spans
rewritten in loose forms are positive; refuted candidates are negative, as they are written
like, and stand where, digit runs do that pass a check by chance. On held-out loose
candidates of a kind, all forms of a base span held out together, the trees' margins are
calibrated to probabilities (Platt's sigmoid), and its threshold is the least probability
with which Wilson's lower bound of their precision reaches the asked one; a kind whose
held-out candidates can't show it, for want of either label, adds nothing.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patentlake.llm._io import bounded

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS = 4000
SAMPLE_ROWS = 4000  # candidates of a kind and label that reach the driver
PART = 1000  # candidates handed on at once
PRECISION = 0.95
Z = 1.2816  # of the bound: one in ten samples would show more than there is
FORMS = 3  # in which a base span is rewritten
#: candidates of a kind that pass its checks by chance, for each one that they refute: Luhn's passes one number in ten
CHANCE = (1.0, 1.0, 1 / 9, 1.0)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive, and from the start of a digit run only: the same matches without backtracking
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:@|\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}){1,5}"),
    "ip": re.compile(r"(?<![\w.])\d{1,4}(?: ?(?:[.,:\u00b7\uff0e]|\[\.\]|\(\.\)|\[dot\]|\(dot\)| dot ) ?\d{1,4}){3}(?!\w)"),
    "card": re.compile(r"(?<!\w)\d(?:[ ._/\u00a0\u2010-\u2015\u2212-]{0,3}+\d)++"),
    "phone": re.compile(r"(?<!\w)\+?\(?\d{1,4}\)?(?:[ ./\u00a0\u2010-\u2015\u2212-]{1,2}\(?\d{2,5}\)?){1,5}(?!\w)"),
}
_ANY_DIGIT = re.compile(r"\d")
_HINTS = [re.compile(p, re.I) for p in (r"mail|contact|write", r"\bip\b|host|server|address", r"card|visa|credit|account|pay", r"tel|phone|call|fax|mobile", r"version|release|chapter|section|date|isbn|order|invoice|token|key")]


_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}([-./])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})")
_AT = re.compile(r" ?(@|\[at\]|\(at\)| at ) ?")
_DOT = re.compile(r" ?(?:\.|\[dot\]|\(dot\)| dot ) ?")
_RUNS = re.compile(r"\d+")
_GAP = re.compile(r"[ -]")
_FULL_WIDTH = {48 + k: 0xFF10 + k for k in range(10)}
# What a loose address is written with, in place of @ and of the dot.
_REWRITTEN = ((" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"), (" at ", "."), (" @ ", "."))
# What separates the parts of a loose IP address, the groups of a loose card number or of a phone number.
_IP_DOTS = (",", " . ", "[.]", " dot ", "(dot)", "\uff0e")
_CARD_GAPS = (".", "/", " - ", "\u2011", "\u00a0", "_", "  ")
_PHONE_GAPS = ("\u2011", "\u00a0", "/", ".")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def _digits(s: str) -> str:
    """The decimal digits, of any script, as ASCII."""
    return "".join(c if c.isascii() else str(unicodedata.decimal(c)) for c in s if c.isdecimal())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules: leftmost non-overlapping matches of each kind that pass its check."""
    out = [Span(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(Span(m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            d = _digits(m.group()) if m.end() - m.start() < 64 else ""
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(Span(m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    out.append(Span(m.start(), 3, m.end()))
    return sorted(out)


def _loose_emails(text: str, start: int = 0, end: int | None = None) -> Iterator[Span]:
    """Loose addresses; where one runs past the end of a sentence, also without what follows."""
    for m in _LOOSE["email"].finditer(text, start, len(text) if end is None else end):
        yield Span(m.start(), 0, m.end())
        cut = m.group().find(". ")
        if cut > 0 and _LOOSE["email"].fullmatch(m.group()[:cut]):
            yield Span(m.start(), 0, m.start() + cut)


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """What the generators propose beside base spans; spans may overlap each other."""
    known = set(base)
    out = []
    digits = _ANY_DIGIT.search(text)
    if "@" in text or "[at]" in text or "(at)" in text or " at " in text:  # no match without one of them
        out += _loose_emails(text)
    if digits:
        for k in (1, 2, 3):
            for m in _LOOSE[KINDS[k]].finditer(text):
                n = len(_digits(m.group())) if m.end() - m.start() < 64 else 99
                if k == 1 or (k == 2 and 12 <= n <= 19) or (k == 3 and 7 <= n <= 15):
                    out.append(Span(m.start(), k, m.end()))
    return [s for s in out if s not in known]


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    s = text[span.start : span.end]
    before, after = text[max(0, span.start - 32) : span.start], text[span.end : span.end + 16]
    digits = _digits(s)
    groups = _RUNS.findall(s)
    last = before[-1:] or " "
    nxt = after[:1] or " "
    return [
        *(float(span.kind == k) for k in range(len(KINDS))),
        len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(s.startswith("+")), s.count("("), s.count("."), s.count("-"), s.count(" "), s.count("/"), float("@" in s),
        s.count(","), float(len({len(g) for g in groups}) == 1), len(set(_RUNS.sub("", s))), float(not s.isascii()), float("[" in s or "dot" in s),
        sum(c.isalpha() for c in s) / len(s),
        float(last.isalnum()), float(nxt.isalnum()), float(last.isspace()), float(nxt in ".,;:!?)" or nxt.isspace()),
        *(float(bool(h.search(before))) for h in _HINTS),
        *(_address(s) if span.kind == 0 else (0.0,) * 5),
    ]


def _address(s: str) -> tuple[float, ...]:
    """How an address is written: bracketed or bare at, dots spelled out, end of a sentence, web site, letters only before the at."""
    at = _AT.search(s)
    name, rest = (s[: at.start()], s[at.end() :]) if at else (s, "")
    return (float(bool(at) and at[1][0] in "[("), float(bool(at) and at[1] == " at "), float("dot" in _DOT.sub(lambda m: m.group().replace(".", ""), rest)), float(". " in rest), float(rest.lower().startswith("www.")) + 2.0 * name.isalpha())


def _inside(span: Span, base: list[Span]) -> bool:
    """Whether a span lies in a base address of either kind; base is sorted, and spans of a kind don't overlap."""
    wanted = {0, 1}
    for b in reversed(base[max(0, bisect.bisect_right(base, Span(span.start, 9, 0)) - 64) : bisect.bisect_right(base, Span(span.start, 9, 0))]):
        if b.kind in wanted:
            if span.end <= b.end:
                return True
            wanted.discard(b.kind)
    return False


def _crosses(span: Span, base: list[Span]) -> bool:
    """Whether a run of digits shares some with a base span of another kind; base is sorted."""
    at = bisect.bisect_left(base, Span(span.end, -1, 0))
    return any(b.end > span.start and b.kind != span.kind for b in base[max(0, at - 64) : at])


def refuted(text: str, span: Span, base: list[Span]) -> bool:
    """Whether a loose candidate is shown not to be what its kind says."""
    s = text[span.start : span.end]
    digits = _digits(s)
    if span.kind == 0:
        at = _AT.search(s)
        rest = s[at.end() :] if at else ""
        # a site, past the end of a sentence, or no letters where a domain ends
        return bool(at) and (at[1] == " at " and (rest.lower().startswith("www.") or ". " in rest) or bool(re.search(r"[a-z]\. [A-Z]", rest)) or not _DOT.split(rest)[-1].isalpha())
    if _crosses(span, base):
        return True
    if span.kind == 1:
        return any(int(_digits(g)[-6:]) > 255 for g in _RUNS.findall(s))
    if span.kind == 2:
        return not luhn(digits) or len(set(digits)) == 1
    if _DATE.fullmatch(s) or _inside(span, base):
        return True
    # a piece of a longer number
    return bool(re.search(r"[0-9][.,:/-]?$", text[max(0, span.start - 2) : span.start]) or re.match(r"[.,:/-]?[0-9]", text[span.end : span.end + 2]))


def rewritten(text: str, span: Span, form: int) -> tuple[str, Span] | None:
    """The text around a base span in a loose form, and the candidate that stands there; None where the generators wouldn't find it."""
    s, first = text[span.start : span.end], max(0, span.start - 64)
    text, span = text[first : span.end + 96], Span(span.start - first, span.kind, span.end - first)  # what features can see
    if span.kind == 0:
        at, dot = _REWRITTEN[form % len(_REWRITTEN)]
        name, _, host = s.partition("@")
        s = f"{name}{at}{host.replace('.', dot)}"
    elif span.kind == 1:
        s = s.replace(".", _IP_DOTS[form % len(_IP_DOTS)])
    elif span.kind == 2:
        gap = _CARD_GAPS[form % len(_CARD_GAPS)]
        s = _GAP.sub(gap, s) if _GAP.search(s) else gap.join(s[k : k + 4] for k in range(0, len(s), 4)) if form % 2 else s.translate(_FULL_WIDTH)
    elif form % 3 < 2:
        s = s[1:] if form % 3 else re.sub(r"^\+[0-9]{1,3}(?:[ .-]+|(?=\())", "", s)
    else:
        s = _GAP.sub(_PHONE_GAPS[form % len(_PHONE_GAPS)], s)
    loose = Span(span.start, span.kind, span.start + len(s))
    changed = text[: span.start] + s + text[span.end : span.end + 96]
    window = max(0, span.start - 1), loose.end + 80
    found = _loose_emails(changed, *window) if span.kind == 0 else (Span(m.start(), span.kind, m.end()) for m in _LOOSE[KINDS[span.kind]].finditer(changed, *window))
    return (changed, loose) if loose in found and loose not in base_spans(changed) else None


N_FEATURES = len(features("1", Span(0, 1, 1)))


class Trees(NamedTuple):
    """Boosted trees of depth 3 in heap order: feature and cut of 7 inner nodes, values of 8 leaves."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(3):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            z += v[node - 7]
        return z


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 30, rate: float = 0.3, smooth: float = 1.0) -> Trees:
    """Fit logistic loss; splits are sought among up to 31 quantiles of each feature."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    z = np.full(len(y), bias)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, cut = np.zeros(7, dtype=np.int64), np.full(7, np.inf)
        for k in range(7):
            own = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf)
            total_g, total_h = grad[own].sum(), hess[own].sum()
            for f, c in enumerate(cuts):
                g = np.cumsum(np.bincount(bins[own, f], grad[own], len(c) + 1))[:-1]
                h = np.cumsum(np.bincount(bins[own, f], hess[own], len(c) + 1))[:-1]
                gain = g**2 / (h + smooth) + (total_g - g) ** 2 / (total_h - h + smooth) - total_g**2 / (total_h + smooth)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), f, c[int(gain.argmax())])
            feature[k], cut[k] = best[1], best[2]
            node[own] = 2 * k + 1 + (x[own, best[1]] > best[2])
        value = np.array([rate * grad[node == k].sum() / (hess[node == k].sum() + smooth) for k in range(7, 15)])
        z += value[node - 7]
        trees.append((feature, cut, value))
    return Trees(*(np.array(t) for t in zip(*trees, strict=True)), bias)


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that turns margins into probabilities, by Newton's method on smoothed labels."""
    good = int(y.sum())
    target = np.where(y, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


class Model(NamedTuple):
    trees: Trees
    sigmoids: tuple[tuple[float, float], ...]  # of each kind
    thresholds: tuple[float, ...]  # probabilities; above 1: the kind adds nothing

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of candidates being what their kind says."""
        slope, offset = np.array(self.sigmoids)[np.argmax(x[:, : len(KINDS)], axis=1)].T
        return 1 / (1 + np.exp(-np.clip(slope * self.trees.margin(x) + offset, -30, 30)))


def wilson(good: np.ndarray, n: np.ndarray, z: float = Z) -> np.ndarray:
    """Lower bound of a share of which good of n were seen."""
    p = good / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(x: np.ndarray, y: np.ndarray, loose: np.ndarray, group: np.ndarray, precision: float = PRECISION, least: int = 20) -> Model | None:
    """Trees from three of four groups, sigmoids and thresholds from the loose rows of the others; None without both labels."""
    if len(y) < 4 * least or y.min() == y.max():
        return None
    test = group % 4 == 0
    if not test.any() or test.all():
        return None
    if y[~test].min() == y[~test].max():
        return None
    trees = boost(x[~test], y[~test].astype(float))
    kept = [test & loose & (x[:, k] == 1) for k in range(len(KINDS))]
    sigmoids = tuple(calibrate(trees.margin(x[own]), y[own]) if 0 < y[own].sum() < own.sum() else (1.0, 0.0) for own in kept)
    model = Model(trees, sigmoids, (2.0,) * len(KINDS))
    thresholds = []
    for own, chance in zip(kept, CHANCE, strict=True):
        p = model.probability(x[own])
        order = np.argsort(-p, kind="stable")
        s, good = p[order], np.cumsum(y[own][order])
        n = np.arange(1, len(s) + 1)
        last = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, dtype=bool)
        right = int(good[-1]) if len(s) else 0
        if not 0 < right < len(s):
            thresholds.append(2.0)
            continue
        # as if there were as many of either label: the sample's share of positives is our own doing
        hit, miss = wilson(good, right), 1 - wilson(len(s) - right - (n - good), len(s) - right)
        ok = last & (hit >= precision * (hit + chance * miss)) & (n >= least)
        thresholds.append(float(s[ok].min()) if ok.any() else 2.0)
    return model._replace(thresholds=tuple(thresholds))


def training_rows(docs: DataFrame, text: str = "text", sample: int = SAMPLE_TEXTS, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled candidates (kind, x, y, loose, key) of up to `sample` distinct texts with a digit or @.

    Of each kind, label and looseness at most `rows`, those of least key hash. Texts and
    candidates are made distinct in Spark, so copies never reach the driver.
    """
    some = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    chosen = some.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(sample)

    def labelled(t: str, h: int) -> Iterator[tuple[str, Span, bool, bool, str]]:
        base = base_spans(t)
        for k, s in enumerate(base):
            yield t, s, True, False, f"{h}:{s.start}:{s.end}:{s.kind}:base"
            for form in range(FORMS):
                if r := rewritten(t, s, (h + k + form * 5) % 420):
                    yield *r, True, True, f"{h}:{s.start}:{s.end}:{s.kind}:rewritten{form}"
        for s in loose_spans(t, base):
            if refuted(t, s, base):
                yield t, s, False, True, f"{h}:{s.start}:{s.end}:{s.kind}:refuted"

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for t, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                each = labelled(t, h)
                while some := list(itertools.islice(each, PART)):
                    kinds, x, good, loose, key = zip(*((s.kind, np.array(features(w, s)).tobytes(), y, free, k) for w, s, y, free, k in some), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(x, pa.binary()), pa.array(good, pa.bool_()), pa.array(loose, pa.bool_()), pa.array(key, pa.string())], names=["kind", "x", "y", "loose", "key"])

    seen = some.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"])
    found = seen.mapInArrow(run, "kind int, x binary, y boolean, loose boolean, key string").dropDuplicates(["key"])
    place = F.row_number().over(Window.partitionBy("kind", "y", "loose").orderBy(F.xxhash64("key"), "key"))
    return found.withColumn("place", place).where(F.col("place") <= rows).drop("place")


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE_TEXTS, rows: int = SAMPLE_ROWS, **options) -> Model | None:
    """Model from the bounded training rows of docs."""
    got = training_rows(docs, text, sample, rows).toPandas().sort_values("key")
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float64).reshape(-1, N_FEATURES)
    group = np.array([zlib.crc32(k.rpartition(":")[0].encode()) for k in got["key"]], dtype=np.int64)
    return fit(x, got["y"].to_numpy(dtype=bool), got["loose"].to_numpy(dtype=bool), group, **options)


def select(text: str, model: Model | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text."""
    base = base_spans(text)
    if model is None:
        return base, base
    loose = [s for s in loose_spans(text, base) if not refuted(text, s, base)]
    if not loose:
        return base, base
    score = model.probability(np.array([features(text, s) for s in loose]))
    added = [s for s, p in zip(loose, score.tolist(), strict=True) if p >= model.thresholds[s.kind]]
    return base, sorted({*base, *added})


def redact(text: str, spans: list[Span]) -> str:
    """Text with each run of overlapping spans replaced by the kind of its first."""
    out, at, end = [], 0, -1
    for s in spans:
        if s.start >= end:
            out += [text[at : s.start], f"[{KINDS[s.kind]}]"]
        end = max(end, s.end)
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def find_pii(docs: DataFrame, text: str = "text", model: Model | None = None, fit_model: bool = True) -> DataFrame:
    """Every row of docs with n_email, n_ip, n_card, n_phone (base spans), base, spans and redacted.

    base and spans: kind:start:end in code points, comma-joined by start, then kind. Null
    text is empty and stays null in `redacted`. Without a text to learn from only base spans
    are found. Repeated rows each get a row; empty docs give an empty table; columns named
    like a result are replaced, others pass through. Narrow but for the sample's hashes.
    """
    model = train(bounded(docs), text) if model is None and fit_model else model
    results = (*(f"n_{k}" for k in KINDS), "base", "spans", "redacted")
    keep = [c for c in docs.columns if c not in results]
    names = [f"k{i}" for i in range(len(keep))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)])
    at = names[keep.index(text)]
    kinds = "".join(f"{n} {source.schema[n].dataType.simpleString()}, " for n in names)

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            counts, base, spans, clean = [], [], [], []
            for value in batch.column(at):
                t = value.as_py()
                b, s = select(t or "", model)
                counts.append([sum(x.kind == k for x in b) for k in range(len(KINDS))])
                base.append(_joined(b))
                spans.append(_joined(s))
                clean.append(redact(t, s) if s else t)
            n = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(n[:, k]) for k in range(len(KINDS))), pa.array(base, pa.string()), pa.array(spans, pa.string()), pa.array(clean, pa.string())], names=[*names, *results])

    out = source.mapInArrow(run, kinds + "".join(f"n_{k} long, " for k in KINDS) + "base string, spans string, redacted string")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *results)


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(_joined(spans).encode()).hexdigest()
