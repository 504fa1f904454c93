"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The field scores whole candidate spans.  A dynamic program over the tokens of a stretch of text
chooses boundaries and kinds of all spans together; a span has a bounded number of tokens.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.env import checkpointed
from chirplens.llm.common import as_text, bound_batches

KINDS = ("email", "ip", "card", "phone")

# --- fixed patterns ----------------------------------------------------------------------
# The patterns are given; they are written here so that no text takes more than
# linear time (an e-mail is found from its "@", a number only at the start of its digits).
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    found: list[Span] = []
    past = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            past = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# --- candidate spans and their features --------------------------------------------------

MOST_TOKENS = 7
CONTEXT = 3
# A stretch is cut after so many tokens, so that its table stays small in any text.
MOST_STRETCH = 400

_TOKEN = re.compile(r"\S+")
_SIGNAL = re.compile(r"[0-9]|@|[\[(]at[\])]|\bdot\b", re.IGNORECASE)
_STRIP_LEFT, _STRIP_RIGHT = "\"'<>[{|=:;,.", "\"'<>]}|=:;,.!?"
_DOT = r"(?:\.|\s*[\[(]dot[\])]\s*|\s+dot\s+)"
_MAIL = re.compile(
    rf"[a-z0-9_%+-]+(?:{_DOT}[a-z0-9_%+-]+)*(?:@|\s*[\[(]at[\])]\s*|\s+at\s+)[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)+",
    re.IGNORECASE,
)
_IP_LIKE = re.compile(r"[0-9]{1,3}(?:\s*[.]\s*[0-9]{1,3}){3}|[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}")
_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().‐-― /-]*[0-9]")
_CUES = {
    "email": {"mail", "email", "e-mail", "contact", "courriel", "correo"},
    "ip": {"ip", "host", "server", "address", "adresse"},
    "card": {"card", "visa", "mastercard", "carte", "karte", "tarjeta"},
    "phone": {"call", "tel", "phone", "fax", "mobile", "telefon", "téléphone", "teléfono"},
}


@dataclass(frozen=True)
class Candidate:
    first: int  # first token, and the token after the last
    past: int
    kind: str
    start: int  # code points of the text
    end: int
    features: tuple[str, ...]


def _kinds(span: str, digits: str) -> list[str]:
    """Kinds that a span can be at all."""
    kinds = []
    if _MAIL.fullmatch(span):
        kinds.append("email")
    if digits:
        if 7 <= len(digits) <= 18 and _IP_LIKE.fullmatch(span) or 4 <= len(digits) <= 12 and _IP_LIKE.fullmatch(span):
            if all(int(p) <= 255 for p in re.findall(r"[0-9]+", span)):
                kinds.append("ip")
        if _NUMBER.fullmatch(span):
            if 13 <= len(digits) <= 19 and luhn(digits):
                kinds.append("card")
            if 8 <= len(digits) <= 15:
                kinds.append("phone")
    return kinds


def _features(span: str, digits: str, kind: str, tokens: int, before: str, left: str, right: str) -> tuple[str, ...]:
    """What the whole span looks like, and what stands around it."""
    groups = re.findall(r"[0-9]+", span)
    shape = "-".join(str(len(g)) for g in groups) if kind in ("card", "phone") else str(len(groups))
    separators = "".join(sorted(set(re.sub(r"[0-9A-Za-z]", "", span))))
    found = [
        "bias",
        f"tokens={tokens}",
        f"digits={len(digits)}",
        f"shape={shape[-12:]}",
        f"last={shape[-3:]}",
        f"groups={min(len(groups), 6)}",
        f"separators={separators[:6]}",
        f"plus={span[:1] == '+'}",
        f"brackets={'(' in span}",
        f"plain={span.isdigit()}",
        f"left={'d' if left.isdigit() else 'a' if left.isalpha() else left}",
        f"right={'d' if right.isdigit() else 'a' if right.isalpha() else right}",
    ]
    if before in _CUES[kind]:
        found.append("cue")
    if kind == "email":
        found.append(f"words={' at ' in span.lower()}{' dot ' in span.lower()}")
        found.append(f"end={len(re.split(r'[^A-Za-z0-9]+', span)[-1])}")
    if kind in ("card", "phone"):
        found.append(f"luhn={luhn(digits)}")
        found.append(f"date={bool(re.fullmatch(r'(19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](19|20)[0-9]{2}', span))}")
    return tuple(f"{kind}:{x}" for x in found)


def _beside(letter: str) -> str:
    """The end of a text is like white space."""
    return " " if not letter or letter.isspace() else letter


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[Candidate]:
    """All spans of at most ``MOST_TOKENS`` tokens that can be of some kind."""
    found = []
    signal = [bool(_SIGNAL.search(text, a, b)) for a, b in tokens]
    for i, (start, _) in enumerate(tokens):
        for j in range(i + 1, min(len(tokens), i + MOST_TOKENS) + 1):
            if not any(signal[i:j]):
                continue
            a, b = start, tokens[j - 1][1]
            while a < b and text[a] in _STRIP_LEFT:
                a += 1
            while a < b and text[b - 1] in _STRIP_RIGHT:
                b -= 1
            if text[a : a + 1] == "(" and ")" not in text[a:b]:
                a += 1
            elif text[b - 1 : b] == ")" and "(" not in text[a:b]:
                b -= 1
            span = text[a:b]
            if not span or len(span) > 120:
                continue
            digits = _digits(span)
            before = re.sub(r"\W", "", text[slice(*tokens[i - 1])]).lower() if i else ""
            for kind in _kinds(span, digits):
                features = _features(span, digits, kind, j - i, before, _beside(text[a - 1 : a] if a else ""), _beside(text[b : b + 1]))
                found.append(Candidate(i, j, kind, a, b, features))
    return found


@dataclass(frozen=True)
class SemiCrf:
    """Weights of span features; tokens outside spans score 0."""

    weights: dict[str, float]

    def score(self, c: Candidate) -> float:
        return sum(self.weights.get(f, 0.0) for f in c.features)

    def best(self, size: int, spans: list[Candidate]) -> list[Candidate]:
        """The non-overlapping spans of greatest total score among ``size`` tokens."""
        ending: dict[int, list[Candidate]] = {}
        for c in spans:
            ending.setdefault(c.past, []).append(c)
        best, back = [0.0] * (size + 1), [None] * (size + 1)
        for t in range(1, size + 1):
            best[t] = best[t - 1]
            for c in ending.get(t, ()):
                value = best[c.first] + self.score(c)
                if value > best[t]:
                    best[t], back[t] = value, c
        chosen, t = [], size
        while t > 0:
            if back[t] is None:
                t -= 1
            else:
                chosen.append(back[t])
                t = back[t].first
        return chosen[::-1]


def fit(windows: list[tuple[str, list[Span]]], epochs: int = 15, l2: float = 1e-3) -> SemiCrf:
    """Maximum likelihood of the true segmentation of each window against all others.

    Sums over all segmentations come from the forward and backward tables of the same dynamic
    program that decodes.  A window's size is bounded, the number of windows by the caller.
    """
    names: dict[str, int] = {}
    rows = []
    for text, gold in windows:
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        spans = candidates(text, tokens)
        truth = set(gold)
        marked = [(c, (c.kind, c.start, c.end) in truth) for c in spans]
        if not marked:
            continue
        ids = [np.array([names.setdefault(f, len(names)) for f in c.features]) for c, _ in marked]
        rows.append((len(tokens), [c for c, _ in marked], ids, np.array([float(g) for _, g in marked])))
    w = np.zeros(len(names))
    squares = np.full(len(names), 1e-8)
    for _ in range(epochs):
        for size, spans, ids, truth in rows:
            scores = [float(w[i].sum()) for i in ids]
            ending: dict[int, list[int]] = {}
            starting: dict[int, list[int]] = {}
            for k, c in enumerate(spans):
                ending.setdefault(c.past, []).append(k)
                starting.setdefault(c.first, []).append(k)
            ahead, behind = [0.0] * (size + 1), [0.0] * (size + 1)
            for t in range(1, size + 1):
                ahead[t] = np.logaddexp.reduce([ahead[t - 1], *(ahead[spans[k].first] + scores[k] for k in ending.get(t, ()))])
            for t in range(size - 1, -1, -1):
                behind[t] = np.logaddexp.reduce([behind[t + 1], *(behind[spans[k].past] + scores[k] for k in starting.get(t, ()))])
            for k, c in enumerate(spans):
                p = float(np.exp(ahead[c.first] + scores[k] + behind[c.past] - ahead[size]))
                step = truth[k] - p
                grad = step - l2 * w[ids[k]]
                squares[ids[k]] += grad**2
                w[ids[k]] += 0.5 * grad / np.sqrt(squares[ids[k]])
    return SemiCrf({f: float(w[i]) for f, i in names.items() if w[i]})


# --- training windows --------------------------------------------------------------------

# Windows used to fit, at most, of each kind, and of stretches without personal data.
WINDOWS_PER_KIND = 250
_WINDOW_CHARS = 400


def _stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Tokens around signals: the only places where a span can be.  Each stretch is bounded."""
    spots = [m.start() for m in _SIGNAL.finditer(text)]
    if not spots:
        return
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    near: list[list[int]] = []
    reach = MOST_TOKENS
    for spot in spots:
        at = bisect_left(starts, spot + 1) - 1
        a, b = max(0, at - reach), min(len(tokens), at + reach + 1)
        if near and a <= near[-1][1] and near[-1][1] - near[-1][0] < MOST_STRETCH:
            near[-1][1] = max(near[-1][1], b)
        else:
            near.append([a, b])
    for a, b in near:
        yield tokens[a:b]


def _variants(kind: str, span: str) -> list[str]:
    """Other ways to write the same thing, which the fixed patterns miss."""
    if kind == "email":
        local, host = span.split("@")
        return [f"{local} at {host.replace('.', ' dot ')}", f"{local} [at] {host.replace('.', ' [dot] ')}", f"{local}(at){host}"]
    digits = _digits(span)
    if kind == "card" and len(digits) == 16:
        return [".".join(digits[i : i + 4] for i in range(0, 16, 4)), "-".join(digits[i : i + 4] for i in range(0, 16, 4))]
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}"]
    if kind == "ip":
        return [span.replace(".", "[.]")]
    return []


def _other_numbers(key: int) -> list[str]:
    """Numbers that are no personal data."""
    h = int.from_bytes(hashlib.blake2b(str(key).encode(), digest_size=8).digest(), "big")
    y, m, d, n = 1950 + h % 80, 1 + h // 80 % 12, 1 + h // 960 % 28, h % 10**10
    return [f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{y}{m:02}{d:02}", str(n), f"{h % 10**8:08}", f"{n:,}", f"{y}-{y + 5}", f"{h % 10**12}", f"{d:02}/{m:02}/{y}", f"{h % 100:02} {h % 10000:04} {h % 1000:03}"]


def training_windows(rows: list[tuple[int, str, str, str, str]]) -> list[tuple[str, list[Span]]]:
    """Windows with their spans from ``(key, kind, left, span, right)``: as found, rewritten in
    other ways, and with other numbers in the same place."""
    windows = []
    for key, kind, left, span, right in rows:
        def put(text: str, kind: str = kind, left: str = left, right: str = right, known: bool = True) -> None:
            whole = f"{left} {text} {right}"
            gold = [(kind, len(left) + 1, len(left) + 1 + len(text))] if known else []
            windows.append((whole, gold))

        put(span)
        for other in _variants(kind, span):
            put(other)
        numbers = _other_numbers(key)
        for k in range(4):
            put(numbers[(key + 3 * k) % len(numbers)], known=False)
    return windows


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_kind: int = WINDOWS_PER_KIND) -> SemiCrf:
    """Fits the field on at most ``per_kind`` spans of each fixed pattern with the words around
    them, those of least hash; the driver gets these short windows only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in filter(None, batch["text"]):
                for kind, a, b in base_spans(text):
                    if b - a > 100:
                        continue
                    left = text[max(0, a - 60) : a].split()[-CONTEXT:]
                    right = text[b : b + 60].split()[:CONTEXT]
                    out.append((kind, " ".join(left), text[a:b], " ".join(right)))
            yield pd.DataFrame(out, columns=["kind", "l", "span", "r"])

    bound_batches(docs.sparkSession)
    found = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "kind string, l string, span string, r string")
    key = F.xxhash64("kind", "l", "span", "r")
    first = F.row_number().over(Window.partitionBy("kind").orderBy("key", "span"))
    # Spark keeps the first rows of each kind in every task before they meet.
    few = found.withColumn("key", key).distinct().withColumn("n", first).where(F.col("n") <= per_kind)
    rows = checkpointed(few).orderBy("kind", "n").collect()
    return fit(training_windows([(r["key"], r["kind"], r["l"], r["span"], r["r"]) for r in rows]))


# --- whole texts -------------------------------------------------------------------------


def all_spans(text: str, model: SemiCrf) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed patterns, and those with what the field adds; an added span
    overlaps no other."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for tokens in _stretches(text):
        spans = candidates(text, tokens)
        if not spans:
            continue
        for c in model.best(len(tokens), spans):
            at = bisect_left(taken, (c.end, -1))
            if all(b <= c.start for _, b in taken[max(0, at - 3) : at]):
                added.append((c.kind, c.start, c.end))
    seen = sorted(set(base) | set(added), key=lambda s: (KINDS.index(s[0]), s[1]))
    return base, seen


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, model: SemiCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row.

    The counts and the hash are of the fixed patterns, ``spans`` are these and the added ones,
    by kind and start.  NULL counts as empty: no spans.  Whole texts are read, in time linear in
    their length; rows stay where they are.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, T.StringType()),
            *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, seen = all_spans(text or "", model)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(seen)))
            frame = pd.DataFrame(out, columns=names[1:])
            frame.insert(0, id_col, batch["id"].array)
            yield frame[names]

    bound_batches(docs.sparkSession)
    rows = docs.select(as_text(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    return rows.mapInPandas(run, schema).withColumn(id_col, F.col(id_col).cast(kind))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first."""
    if text is None:
        return None
    out, past = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= past:
            out += [text[past:a], f"[{kind}]"]
            past = b
    return "".join(out) + text[past:]


def mask_personal_data(docs: DataFrame, model: SemiCrf, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text column replaced by its kind; NULL stays NULL."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([masked(t, all_spans(t, model)[1]) if t else t for t in batch], dtype=object)

    return docs.withColumn(text_col, mask(F.col(text_col)))
