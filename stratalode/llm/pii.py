"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The field looks for what
they miss: it scores whole candidate segments of a few tokens (how many digits in
which groups, which separators, a valid check digit, the words before) for each
type, and a dynamic program over segments of bounded length picks boundaries and
types jointly. Only stretches around digits, ``@`` or a spelt-out ``at`` can hold
a segment, so only these are decoded; base spans are walls between them.

It is trained on a bounded sample of texts: base spans are its positive examples,
as they are and rewritten in ways the patterns do not cover; all other stretches
are negative ones.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import spare_name
from stratalode.llm.columns import in_share, with_arrow_columns
from stratalode.sinks import stage

KINDS = ("email", "ip", "card", "phone")
FIELDS = "pii array<struct<kind: string, start: int, end: int, base: boolean>>"

# The patterns of the base spans.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# An address can only begin where a run of digits does; saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What every text with a base span matches, and few others; for both Java and Python.
_MAYBE = (
    r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]|[0-9]\.[0-9]+\.[0-9]+\.[0-9]"
    r"|[0-9]([\x20-]?[0-9]){13}|\+[0-9][\x20().0-9-]{8,}[0-9]"
)

_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9]{2,}|@|[0-9][\[(]\.[\])]|[\[(]\s?at\s?[\])]", re.I)
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\S\n]+|.|\n")
_AROUND, MOST_TOKENS = 48, 24
_CUES = {
    "email": ("email", "mail", "contact"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit"), "phone": ("phone", "tel", "call", "mobile", "fax", "telephone"),
}

# Stretches of digits that are no personal data, as further negative examples.
PLAIN = (
    "on 2024-06-01 12:30 we", "at 2023-11-05 08:15:00 the", "since 01.02.2024 10:15 it", "from 1999-2004 and", "the 12/31/2023 11:59",
    "ISBN 978-3-16-148410-0 is", "of 10.20.30.400 and", "about 1 234 567 890 people", "some 12,345,678 of", "id 20240601123000 was",
    "rows 10 2 3 4 and", "scores 10-2-3-1 of", "parts 12/3/4/5 in", "lots [10] [2] [3] [4] are", "of (12) 1 (2) 3 to", "at 300[.]1[.]2[.]3 is",
)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind; code points, end exclusive."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") for part in m[0].split(".")]
            if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                out.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), "phone"))
        out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def stretches(text: str, walls: list[Span]) -> list[tuple[int, int]]:
    """Where a segment could be: around triggers, outside of base spans."""
    wide: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - _AROUND), min(len(text), m.end() + _AROUND)
        if wide and a <= wide[-1][1]:
            wide[-1][1] = b
        else:
            wide.append([a, b])
    blocked: list[list[int]] = []
    for a, b, _ in sorted(walls):
        if blocked and a <= blocked[-1][1]:
            blocked[-1][1] = max(blocked[-1][1], b)
        else:
            blocked.append([a, b])
    out, w = [], 0
    for a, b in wide:
        while w < len(blocked) and blocked[w][1] <= a:
            w += 1
        k = w
        while k < len(blocked) and blocked[k][0] < b:
            if blocked[k][0] > a:
                out.append((a, blocked[k][0]))
            a = blocked[k][1]
            k += 1
        if a < b:
            out.append((a, b))
    return [(a, b) for a, b in out if _TRIGGER.search(text, a, b)]


@dataclass
class Field:
    """Weights of whole-segment features; decoding and training."""

    weights: dict[str, float] = field(default_factory=dict)

    def score(self, features: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def decode(self, text: str, a: int, b: int) -> list[Span]:
        """The best segmentation of a stretch; what scores no better than plain text is plain."""
        tokens = [(m.start() + a, m.end() + a) for m in _TOKEN.finditer(text[a:b])]
        by_end = defaultdict(list)
        for i, j, kind, features in candidates(text, tokens):
            by_end[j].append((i, kind, self.score(features)))
        best, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
        for j in range(1, len(tokens) + 1):
            best[j] = best[j - 1]
            for i, kind, score in by_end[j]:
                if best[i] + score > best[j] + 1e-12:
                    best[j], back[j] = best[i] + score, (i, kind)
        out, j = [], len(tokens)
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((tokens[i][0], tokens[j - 1][1], kind))
                j = i
        return out[::-1]

    def train(self, examples: list[tuple[str, list[Span]]], rounds: int = 8, rate: float = 0.5, penalty: float = 1e-3) -> None:
        """Stochastic gradient on the conditional likelihood, with adapted steps.

        Examples with a span that is no candidate (of too many tokens, or inside a word) would count as plain text; they are left out.
        """
        for kind in KINDS:
            self.weights.setdefault(f"{kind}|", -2.0)
        squares: dict[str, float] = defaultdict(lambda: 1e-8)
        prepared = [p for text, spans in examples if sum((p := _prepared(text, spans))[2]) == len(set(spans))]
        for _ in range(rounds):
            for count, segments, wanted in prepared:
                for f, g in self._gradient(count, segments, wanted).items():
                    g -= penalty * self.weights.get(f, 0.0)
                    squares[f] += g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])

    def _gradient(self, count: int, segments: list, wanted: list[bool]) -> dict[str, float]:
        by_end, by_start = defaultdict(list), defaultdict(list)
        scores = [self.score(s[3]) for s in segments]
        for n, (i, j, _, _) in enumerate(segments):
            by_end[j].append(n)
            by_start[i].append(n)
        ahead, behind = [0.0] * (count + 1), [0.0] * (count + 1)
        for j in range(1, count + 1):
            ahead[j] = _sum([ahead[j - 1]] + [ahead[segments[n][0]] + scores[n] for n in by_end[j]])
        for i in range(count - 1, -1, -1):
            behind[i] = _sum([behind[i + 1]] + [behind[segments[n][1]] + scores[n] for n in by_start[i]])
        out: dict[str, float] = defaultdict(float)
        for n, (i, j, _, features) in enumerate(segments):
            g = wanted[n] - math.exp(min(0.0, ahead[i] + scores[n] + behind[j] - ahead[count]))
            if abs(g) > 1e-4:
                for f in features:
                    out[f] += g
        return out


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _prepared(text: str, spans: list[Span]) -> tuple[int, list, list[bool]]:
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    segments = list(candidates(text, tokens))
    known = set(spans)
    return len(tokens), segments, [(tokens[i][0], tokens[j - 1][1], kind) in known for i, j, kind, _ in segments]


def candidates(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int, str, list[str]]]:
    """Segments (first token, end token, kind, features) that could be of a kind at all."""
    for i, (start, _) in enumerate(tokens):
        c = text[start]
        before = text[start - 1] if start else " "
        if (c.isdigit() or c in "+(") and not before.isalnum():
            digits = groups = 0
            for j in range(i, min(i + MOST_TOKENS, len(tokens))):
                a, b = tokens[j]
                piece = text[a:b]
                if piece[0].isdigit():
                    if not piece.isascii():
                        break
                    digits += len(piece)
                    groups += 1
                    after = text[b] if b < len(text) else " "
                    if digits > 19:
                        break
                    if 4 <= digits < 7 and groups == 4 and not after.isalnum():
                        yield i, j + 1, "ip", features(text, start, b, "ip")
                    if digits >= 7 and not after.isalnum():
                        for kind in ("ip", "card", "phone") if 13 <= digits <= 15 else ("card",) if digits > 15 else ("ip", "phone"):
                            yield i, j + 1, kind, features(text, start, b, kind)
                elif piece not in (" ", "-", ".", "(", ")", "+", "/", "[", "]"):
                    break
        if (c.isascii() and c.isalnum()) and before not in _LOCAL:
            has_at = False
            for j in range(i, min(i + MOST_TOKENS, len(tokens))):
                a, b = tokens[j]
                piece = text[a:b]
                if piece == "@" or piece.lower() == "at" and text[a - 1 : a] in "[(":
                    if has_at:
                        break
                    has_at = True
                elif piece == "\n" or len(piece) > 1 and piece.isspace() or piece[0] not in _LOCAL and piece[0] not in " []()":
                    break
                elif piece == " " and not has_at and text[b : b + 1] not in "[(@" and text[a - 1] not in "])":
                    break
                if has_at and piece.isalnum() and piece.lower() not in ("at", "dot") and (b == len(text) or not text[b].isalnum()):
                    yield i, j + 1, "email", features(text, start, b, "email")


def features(text: str, a: int, b: int, kind: str) -> list[str]:
    """What is known of a segment as a whole, each for its kind."""
    body = text[a:b]
    groups = re.findall(r"[0-9]+", body)
    digits = "".join(groups)
    out = ["", f"start {'+' if body[0] == '+' else '(' if body[0] == '(' else 'x'}"]
    if kind == "email":
        domain = re.split(r"@|[\[(]\s?at\s?[\])]", body, maxsplit=1, flags=re.I)[-1].strip()
        dots = len(re.findall(r"\.|[\[(]\s?dot\s?[\])]", domain, re.I))
        last = re.split(r"[^A-Za-z0-9-]+", domain)[-1]
        out += [f"at {'@' in body}", f"dots {min(dots, 3)}", f"end {last.isalpha()} {min(len(last), 5)}", f"spaces {min(body.count(' '), 5)}"]
        out.append(f"more {text[b : b + 1] in '.-' and text[b + 1 : b + 2].isalnum()}")
    else:
        separators = "".join(sorted(set(re.sub(r"[0-9]", "", body))))
        out += [f"digits {len(digits)}", f"groups {'-'.join(str(len(g)) for g in groups)}", f"between {separators}"]
        if kind == "card":
            out += [f"check {luhn(digits)}", f"check {luhn(digits)} {len(digits)}", f"even {len({len(g) for g in groups}) == 1}"]
        if kind == "ip":
            fits = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
            out += [f"fits {fits}", f"fits {fits} {separators}"]
        if kind == "phone":
            out.append(f"long {len(digits) >= 10} {separators}")
        out.append(f"beside {text[a - 1 : a] in ('.', '-', '/', '_', '#')} {text[b : b + 1] in ('-', '/', '_') or text[b : b + 1] == '.' and text[b + 1 : b + 2].isdigit()}")
    words = re.findall(r"[A-Za-z]+", text[max(0, a - 24) : a])[-2:]
    out.append(f"cue {any(w.lower() in _CUES[kind] for w in words)}")
    return [f"{kind}|{f}" for f in out]


def rewritten(body: str, kind: str, n: int) -> str | None:
    """A base span in a form that the patterns do not cover."""
    if kind == "email":
        return body.replace("@", (" [at] ", " (at) ", "[at]")[n % 3], 1)
    if kind == "ip":
        return body.replace(".", "[.]")
    digits = re.sub(r"[^0-9]", "", body)
    if kind == "card":
        mark = "./"[n % 2]
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if len(digits) < 10:
        return None
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return (f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"({area}) {middle} {last}")[n % 4]


def examples_of(text: str) -> list[tuple[str, list[Span]]]:
    """Training stretches of a text, each with its spans."""
    spans = base_spans(text)
    out = [(text[a:b], []) for a, b in stretches(text, spans)]
    for a, b, kind in spans:
        left, right = text[max(0, a - _AROUND) : a], text[b : b + _AROUND]
        if base_spans(left) or base_spans(right):
            left, right = left[-1:], right[:1]
        for body in (text[a:b], rewritten(text[a:b], kind, sum(map(ord, text[a:b])))):
            if body:
                out.append((left + body + right, [(len(left), len(left) + len(body), kind)]))
    return out


def fit_pii(docs: DataFrame, max_docs: int = 2_000, max_examples: int = 6_000, text: str = "text") -> Field:
    """Train the field on at most ``max_docs`` different texts with a digit or ``@``, and as many with base spans.

    Both are those of the smallest hashes among about ``16 * max_docs`` such rows,
    which the hash picks out of all such rows, however rare they are; copies count
    once. Of their stretches at most ``max_examples`` are used, evenly spread, but an
    eighth of them have base spans if there are so many. Without such texts the
    field finds nothing and only base spans are reported.
    """
    texts = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))

    def with_base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(base_spans(t)) for t in batch.column(0).to_pylist()], pa.bool_()))

    def drawn(rows: DataFrame) -> DataFrame:
        order = F.xxhash64(F.lit(3), "text")
        rows = rows.where(in_share(order, 16 * max_docs / max(rows.count(), 1))).distinct()
        return rows.withColumn("order", order).orderBy("order", "text").limit(max_docs).select("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [e for t in batch.column(0).to_pylist() for e in examples_of(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in r[1]) for r in rows], pa.string())],
                ["stretch", "spans"],
            )

    sample = drawn(texts).unionByName(drawn(texts.where(F.col("text").rlike(_MAYBE)).mapInArrow(with_base, "text string")))
    rows = stage(sample.distinct().mapInArrow(cut, "stretch string, spans string").distinct(), "stretches")
    ordered = rows.orderBy(F.xxhash64("stretch", "spans"), "stretch", "spans")
    taken = ordered.limit(max_examples).collect()
    held = [r for r in taken if r["spans"]]
    if len(held) < max_examples // 8:
        held = ordered.where("spans <> ''").limit(max_examples // 8).collect()
        taken = held + [r for r in taken if not r["spans"]][: max_examples - len(held)]
        taken.sort(key=lambda r: hashlib.blake2b(f"{r['stretch']}\0{r['spans']}".encode(), digest_size=8).digest())
    found = Field()
    plain = [(text, []) for text in PLAIN if taken for _ in range(5)]
    found.train(plain + [(r["stretch"], [(int(a), int(b), k) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]) for r in taken])
    return found


def find_spans(text: str, model: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    if not _DIGIT.search(text) and "@" not in text and not _TRIGGER.search(text):
        return base, base
    more = [s for a, b in stretches(text, base) for s in model.decode(text, a, b)]
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))) if more else base


def find_pii(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: all spans (kind, start, end, base), by start, then kind.

    Positions are code points of the whole text, ends exclusive. NULL and empty
    texts have none. Repeated rows stay; a column called ``pii`` is replaced; an
    empty table gives an empty result. Added spans never overlap base ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def make(batch: pa.RecordBatch) -> list:
        own, out = Field(shared.value), []
        for value in batch.column(text).to_pylist():
            base, spans = find_spans(value or "", own)
            out.append(_rows(base, spans))
        return [pa.array(out, kind)]

    return with_arrow_columns(docs, make, FIELDS)


def spans_text(spans):
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """`find_pii`, with each span, or run of overlapping ones, replaced in the text by ``[KIND]`` of its first."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def make(batch: pa.RecordBatch) -> list:
        own, texts, found = Field(shared.value), [], []
        for value in batch.column(text).to_pylist():
            base, spans = find_spans(value or "", own)
            found.append(_rows(base, spans))
            texts.append(value if not spans else _without(value, spans))
        return [pa.array(found, kind), pa.array(texts, pa.string())]

    spare = spare_name(docs.columns, "_redacted")
    return with_arrow_columns(docs, make, f"{FIELDS}, {spare} string").withColumn(text, F.col(spare)).drop(spare)


def _rows(base: list[Span], spans: list[Span]) -> list[dict]:
    known = set(base)
    return [{"kind": k, "start": a, "end": b, "base": (a, b, k) in known} for a, b, k in spans]


def _without(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])
