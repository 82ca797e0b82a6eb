"""Personal data: fixed rules plus a character-level BiLSTM-CRF.

The rules (``base_spans``) find e-mail addresses, IP addresses, card and phone
numbers.  The model is trained in numpy from labelled spans, the rules' own
finds in a bounded sample and rewritten forms of them (no plus sign, other
separators, a spelled-out at sign), and adds spans that the rules miss.

The model reads every stretch of text around a digit or an at sign, in
overlapping windows.  Every span it can add holds one of these, so nothing
else can hold a span.  The windows' scores for a character are averaged, the
middle of a window counting most, and each stretch is then decoded as one
sequence, so windows cannot disagree.  A span is added only if it has the
parts its kind must have, touches no rule's span, and is not what a rule of
its kind looked at and rejected, digit for digit.  A part of that may be added,
one of two numbers in a row, but never a part of a run of digits.

Defined results: a null text counts as empty and has no spans.  With nothing
to train on, the rules stand alone.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from policylens.llm.common import with_results

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]                   # start, kind (index), end

# --- rules -------------------------------------------------------------------------------------

_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_dotted = re.compile(r"[0-9.]+").finditer
_grouped = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_dialled = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """One look at every at sign: the run before it, the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _domain(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), True
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four numbers with dots between, from the left, in every run of digits and dots."""
    for run in _dotted(text):
        if run[0].count(".") < 3:
            continue
        parts, at, starts = run[0].split("."), run.start(), []
        for part in parts:
            starts.append(at)
            at += len(part) + 1
        i = 0
        while i + 3 < len(parts):
            if all(parts[i:i + 4]):
                yield starts[i], starts[i + 3] + len(parts[i + 3]), all(map(_octet, parts[i:i + 4]))
                i += 4
            else:
                i += 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def candidates(text: str) -> list[tuple[Span, bool]]:
    """What the rules' patterns match, and whether it passes its check."""
    out = []
    if "@" in text:
        out += [((a, 0, b), ok) for a, b, ok in _emails(text)]
    out += [((a, 1, b), ok) for a, b, ok in _addresses(text)]
    for m in _grouped(text):
        d = _digits(m[0])
        out.append(((m.start(), 2, m.end()), 14 <= len(d) <= 19 and luhn(d)))
    if "+" in text:
        out += [((m.start(), 3, m.end()), 10 <= len(_digits(m[0])) <= 15) for m in _dialled(text)]
    return out


def base_spans(text: str | None) -> list[Span]:
    return sorted(span for span, ok in candidates(text) if ok) if text else []


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


# --- model -------------------------------------------------------------------------------------

WINDOW, STRIDE, CONTEXT = 64, 32, 24
HIDDEN = 16
TAGS = 1 + 2 * len(KINDS)                     # outside; begin and inside of each kind
CHARS = 99
SAMPLE_DOCUMENTS = 20_000
SAMPLE_WINDOWS = 2_500
EPOCHS, BATCH, RATE = 6, 64, 0.02
ROWS = ((2, 2), (3, 1), (3, 2), (2, 1), (1, 2))       # kinds in a row that the rules take for one number
_FORBIDDEN = -30.0
_triggers = re.compile(r"[0-9@]|[\[(]at[\])]", re.IGNORECASE).finditer
_sign = re.compile(r"\s*(?:@|[\[(]at[\])])\s*", re.IGNORECASE)


def encode(text: str) -> np.ndarray:
    """Character classes: 0 padding, 1-95 printable ASCII, then letters, spaces, others."""
    out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    plain = (out >= 32) & (out < 127)
    other = np.where(out < 32, 97, np.where(out < 127, 98, 96))
    return np.where(plain, out - 31, other)


def _name_and_host(text: str, a: int, b: int) -> tuple[int, int]:
    """From the start of the name before the at sign at ``a:b`` to the end of the host after it."""
    while a and text[a - 1].isspace():
        a -= 1
    while a and text[a - 1] in _LOCAL:
        a -= 1
    while b < len(text) and text[b].isspace():
        b += 1
    while b < len(text) and text[b] in _LOCAL:
        b += 1
    return a, b


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of ``text`` around triggers, with their context; near ones are one.  An
    at sign has the whole name before it and the whole host after it."""
    out: list[list[int]] = []
    for m in _triggers(text):
        a, b = m.span()
        if text[a] not in _DIGITS:
            a, b = _name_and_host(text, a, b)
        a, b = max(0, min(a, m.start() - CONTEXT)), min(len(text), max(b, m.end() + CONTEXT))
        while out and a < out[-1][0]:                    # a long name reaches over earlier ones
            b = max(b, out.pop()[1])
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def window_starts(length: int) -> list[int]:
    return [0] if length <= WINDOW else [*range(0, length - WINDOW, STRIDE), length - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _allowed() -> np.ndarray:
    """Scores of tag pairs before learning: inside only after begin or inside of its kind."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = _FORBIDDEN
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


class BiLstmCrf:
    """Two LSTMs over characters, a linear layer, and a linear-chain CRF."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h = HIDDEN
        self.p = {"out": normal(2 * h, TAGS, scale=0.3), "bias": np.zeros(TAGS, np.float32), "pairs": _allowed(),
                  "first": np.zeros(TAGS, np.float32)}
        self.p["first"][2::2] = _FORBIDDEN
        for side in "fb":
            self.p[f"in_{side}"] = normal(CHARS, 4 * h, scale=0.3)
            self.p[f"re_{side}"] = normal(h, 4 * h, scale=0.2)
            self.p[f"in_{side}"][:, h:2 * h] += 1.0       # remember at first

    def _lstm(self, side: str, chars: np.ndarray, keep: list | None = None) -> np.ndarray:
        n, steps = chars.shape
        h = HIDDEN
        inputs = self.p[f"in_{side}"][chars]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.empty((n, steps, h), np.float32)
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            z = inputs[:, t] + state @ self.p[f"re_{side}"]
            gates, new = _sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
            before, before_cell = state, cell
            cell = f * cell + i * new
            squashed = np.tanh(cell)
            state = o * squashed
            out[:, t] = state
            if keep is not None:
                keep.append((t, i, f, o, new, before, before_cell, squashed))
        return out

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._lstm("f", chars), self._lstm("b", chars)], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def loss_and_gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences (padding is outside)."""
        n, steps = chars.shape
        kept: dict[str, list] = {"f": [], "b": []}
        hidden = np.concatenate([self._lstm(s, chars, kept[s]) for s in "fb"], axis=2)
        e = hidden @ self.p["out"] + self.p["bias"]
        pairs, first = self.p["pairs"], self.p["first"]
        alpha = np.empty((steps, n, TAGS), np.float32)
        beta = np.zeros((steps, n, TAGS), np.float32)
        alpha[0] = first + e[:, 0]
        for t in range(1, steps):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + pairs, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(pairs + (e[:, t + 1] + beta[t + 1])[:, None, :], 2)
        whole = _logsum(alpha[-1], 1)
        row = np.arange(n)
        gold = first[tags[:, 0]] + e[row[:, None], np.arange(steps), tags].sum(1) + pairs[tags[:, :-1], tags[:, 1:]].sum(1)
        de = np.exp(alpha + beta - whole[:, None]).transpose(1, 0, 2)
        g = {"first": de[:, 0].sum(0), "pairs": np.zeros_like(pairs)}
        np.add.at(g["first"], tags[:, 0], -1)
        for t in range(1, steps):
            g["pairs"] += np.exp(alpha[t - 1][:, :, None] + pairs + (e[:, t] + beta[t])[:, None, :]
                                 - whole[:, None, None]).sum(0)
        np.add.at(g["pairs"], (tags[:, :-1], tags[:, 1:]), -1)
        de[row[:, None], np.arange(steps), tags] -= 1
        g["bias"] = de.sum((0, 1))
        g["out"] = hidden.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        dh = de @ self.p["out"].T
        one_hot = np.eye(CHARS, dtype=np.float32)[chars]
        for side, part in (("f", dh[:, :, :HIDDEN]), ("b", dh[:, :, HIDDEN:])):
            recurrent = self.p[f"re_{side}"]
            g[f"re_{side}"] = np.zeros_like(recurrent)
            dz = np.empty((n, steps, 4 * HIDDEN), np.float32)
            carry, carry_cell = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t, i, f, o, new, before, before_cell, squashed in reversed(kept[side]):
                d = part[:, t] + carry
                dc = carry_cell + d * o * (1 - squashed * squashed)
                step = np.concatenate([dc * new * i * (1 - i), dc * before_cell * f * (1 - f),
                                       d * squashed * o * (1 - o), dc * i * (1 - new * new)], axis=1)
                dz[:, t] = step
                g[f"re_{side}"] += before.T @ step
                carry, carry_cell = step @ recurrent.T, dc * f
            g[f"in_{side}"] = one_hot.reshape(-1, CHARS).T @ dz.reshape(-1, 4 * HIDDEN)
        return float((whole - gold).mean()), {k: v / n for k, v in g.items()}

    def fit(self, chars: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> BiLstmCrf:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(chars) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(chars))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                _, g = self.loss_and_gradients(chars[rows], tags[rows])
                norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for k, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * x
                    second[k] = 0.999 * second[k] + 0.001 * x * x
                    self.p[k] -= (rate * first[k] / (1 - 0.9 ** step)
                                  / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """The best tags of each of a batch of padded score sequences."""
        n, steps, _ = scores.shape
        pairs = self.p["pairs"]
        back = np.empty((steps, n, TAGS), np.int8)
        best = self.p["first"] + scores[:, 0]
        for t in range(1, steps):
            through = best[:, :, None] + pairs
            back[t] = through.argmax(1)
            moved = through.max(1) + scores[:, t]
            best = np.where((t < lengths)[:, None], moved, best)
        tag, row = best.argmax(1), np.arange(n)
        out = np.zeros((n, steps), np.int8)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            out[:, t] = np.where(inside, tag, 0)
            if t:
                tag = np.where(inside, back[t, row, tag], tag)
        return [out[i, :length] for i, length in enumerate(lengths.tolist())]

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """Tags of each text: overlapping windows, their scores reconciled, one decoding."""
        codes = [encode(t) for t in texts]
        jobs = [(i, a) for i, c in enumerate(codes) for a in window_starts(len(c))]
        totals = [np.zeros((len(c), TAGS), np.float32) for c in codes]
        weights = [np.zeros((len(c), 1), np.float32) for c in codes]
        ramp = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
        for at in range(0, len(jobs), 512):
            part = jobs[at:at + 512]
            chars = np.zeros((len(part), WINDOW), np.int64)
            for r, (i, a) in enumerate(part):
                piece = codes[i][a:a + WINDOW]
                chars[r, :len(piece)] = piece
            for (i, a), e in zip(part, self.emissions(chars), strict=True):
                n = min(WINDOW, len(codes[i]) - a)
                totals[i][a:a + n] += ramp[:n] * e[:n]
                weights[i][a:a + n] += ramp[:n]
        out: list[np.ndarray | None] = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(codes[i]))
        group: list[int] = []
        for place, i in enumerate(order):
            group.append(i)
            longest = len(codes[i])
            following = len(codes[order[place + 1]]) if place + 1 < len(order) else None
            if following is None or following * (len(group) + 1) > 200_000:
                lengths = np.array([len(codes[j]) for j in group])
                scores = np.zeros((len(group), longest, TAGS), np.float32)
                for r, j in enumerate(group):
                    scores[r, :len(codes[j])] = totals[j] / weights[j]
                for j, tags in zip(group, self.decode(scores, lengths), strict=True):
                    out[j] = tags
                group = []
        return out


def tags_of(length: int, spans: Sequence[Span]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for a, k, b in spans:
        if 0 <= a and b <= length and not out[a:b].any():
            out[a:b] = 2 + 2 * k
            out[a] = 1 + 2 * k
    return out


def spans_of(tags: np.ndarray) -> list[Span]:
    if not len(tags):
        return []
    cuts = [0, *(np.flatnonzero((np.diff(tags) != 0) | (tags[1:] % 2 == 1)) + 1).tolist(), len(tags)]
    out: list[list[int]] = []
    for a, b in pairwise(cuts):
        tag = int(tags[a])
        if tag % 2:
            out.append([a, (tag - 1) // 2, b])
        elif tag and out and out[-1][2] == a and out[-1][1] == (tag - 2) // 2:
            out[-1][2] = b
    return [(a, k, b) for a, k, b in out]


# --- training data -----------------------------------------------------------------------------

def rewritten(kind: int, text: str, rng: np.random.Generator) -> str:
    """A form of a span that people write and the rules do not take."""
    pick = int(rng.integers(0, 3))
    if kind == 0:
        return text.replace("@", (" [at] ", "(at)", " @ ")[pick])
    if kind == 1:
        return text.replace(".", (" . ", "[.]", "(.)")[pick])
    d = _digits(text)
    if kind == 2:
        sign = (".", "/", "  ")[pick]
        return sign.join(d[i:i + 4] for i in range(0, len(d), 4))
    local = d[-10:]
    return (f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}",
            f"{local[:3]}.{local[3:6]}.{local[6:]}")[pick]


def training_windows(texts: Iterable[str | None], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Windows with the rules' spans, windows with rewritten spans, windows with
    two numbers in a row, which the rules take for one, and windows around
    digits that are neither (one row per window)."""
    rng = np.random.default_rng(seed)
    chars, tags = [], []
    lately: dict[int, str] = {}                           # the last number of each kind

    def add(text: str, spans: Sequence[Span]) -> None:
        length = min(len(text), WINDOW)
        start = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        if spans:                                         # keep the first span whole where it fits
            a, _, b = spans[0]
            start = int(np.clip(start, max(0, b - WINDOW), max(0, min(a, len(text) - WINDOW))))
        row, marks = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        row[:length] = encode(text[start:start + WINDOW])
        marks[:length] = tags_of(len(text), spans)[start:start + WINDOW]
        if marks[0] and marks[0] % 2 == 0:
            marks[0] -= 1
        chars.append(row)
        tags.append(marks)

    for text in texts:
        if not text:
            continue
        looked = candidates(text)
        spans = sorted(s for s, ok in looked if ok)
        # failed matches that hold a card are no example of what is none
        unclear = [s for s, ok in looked if not ok and s[1] == 2 and any(_cards(text, s[0], s[2]))]
        for a, b in stretches(text):
            inside = [(x - a, k, y - a) for x, k, y in spans if a <= x and y <= b]
            if not any(x < b and a < y for x, _, y in unclear):
                add(text[a:b], inside)
            for x, k, y in inside:
                form = rewritten(k, text[a + x:a + y], rng)
                before, after = text[max(a, a + x - CONTEXT):a + x], text[a + y:min(b, a + y + CONTEXT)]
                add(before + form + after, [(len(before), k, len(before) + len(form))])
                own, x0 = text[a + x:a + y], len(before)
                rows = [r for r in ROWS if k in r and all(o == k or o in lately for o in r)]
                for r in rng.permutation(len(rows))[:2].tolist():
                    one, two = rows[r]
                    # two of a kind: this one and the last one, in either order
                    parts = [own if one == k else lately[one], own if two == k else lately[two]]
                    if one == two:
                        parts[int(rng.integers(0, 2))] = lately.get(k, own)
                    y0 = x0 + len(parts[0]) + 1
                    add(f"{before}{' '.join(parts)}{after}", [(x0, one, y0 - 1), (y0, two, y0 + len(parts[1]))])
                lately[k] = own
    if not chars:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    order = rng.permutation(len(chars))[:SAMPLE_WINDOWS]
    return np.array(chars)[order], np.array(tags)[order]


def train(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> BiLstmCrf | None:
    """Learn from the texts of about ``sample`` documents (at most twice as
    many) chosen by a hash of the id; None if no rule finds anything there."""
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    thin = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30)) < int(min(1.0, sample / max(1, rows)) * (1 << 30))
    # only stretches around triggers travel, and a bounded number of them
    part = F.explode(F.regexp_extract_all("text", F.lit(r"(?s).{0,60}[0-9@](?:.{0,40}[0-9@])*.{0,60}"), F.lit(0)))
    found = (docs.where(thin).select("doc_id", part.alias("part")).where(F.length("part") <= 400)
             .orderBy(F.xxhash64("doc_id", "part"), "part").limit(2 * SAMPLE_WINDOWS).collect())
    chars, tags = training_windows(r["part"] for r in found)
    if not tags.any():
        return None
    return BiLstmCrf().fit(chars, tags)


# --- the operator ------------------------------------------------------------------------------

def plausible(kind: int, text: str) -> bool:
    """Has an added span the parts that its kind must have?"""
    d = _digits(text)
    if kind == 0:
        sign = _sign.search(text)
        return bool(sign and _LOCAL_RUN.search(text[:sign.start()]) and _domain(text, sign.end()))
    if kind == 1:
        numbers = re.findall(r"[0-9]+", text)
        return len(numbers) == 4 and all(map(_octet, numbers)) and not re.search(r"[^0-9.\[\]()\s]", text)
    if kind == 2:
        return 14 <= len(d) <= 19 and luhn(d) and not re.search(r"[^0-9./\s-]", text)
    return 10 <= len(d) <= 15 and not re.search(r"[^0-9()+.\s-]", text)


def _rejects(failed: Span, span: Span, text: str) -> bool:
    """Does a match that failed its check rule out a span of its kind?  If they
    have the same digits, or the span cuts a run of digits of the match."""
    (a, k, b), (x, kind, y) = failed, span
    if k != kind or a >= y or x >= b:
        return False
    cut = any(0 < p < len(text) and text[p - 1] in _DIGITS and text[p] in _DIGITS for p in (x, y))
    return cut or not (_digits(text[min(a, x):max(a, x)]) or _digits(text[min(b, y):max(b, y)]))


def _cards(text: str, start: int, stop: int) -> Iterator[Span]:
    """Whole runs of digits between ``start`` and ``stop`` that make a card, from the left."""
    runs = [(m.start() + start, m.end() + start) for m in re.finditer("[0-9]+", text[start:stop])]
    i = 0
    while i < len(runs):
        size, after = 0, i + 1
        for j in range(i, len(runs)):
            size += runs[j][1] - runs[j][0]
            if size > 19:
                break
            if plausible(2, text[runs[i][0]:runs[j][1]]):
                yield runs[i][0], 2, runs[j][1]
                after = j + 1
                break
        i = after


def _decoded(text: str, tags: np.ndarray, start: int, failed: Sequence[Span]) -> Iterator[Span]:
    """The spans of ``tags``, which begin at ``start``; one of a card also gives the
    cards in it, and in the failed matches that it touches.  An address has its
    whole name and host, as the rules' have."""
    for x, k, y in spans_of(tags):
        a, b = start + x, start + y
        sign = _sign.search(text, a, b) if k == 0 else None
        host = sign and _domain(text, sign.end())
        if host:
            a, b = sign.start(), host.end()
            while a and text[a - 1] in _LOCAL:
                a -= 1
        if k != 2:
            yield a, k, b
            continue
        if plausible(k, text[a:b]):
            yield a, k, b
        for low, kind, high in [(a, k, b), *failed]:
            if kind == k and low < b and a < high:
                yield from _cards(text, low, high)


def find(texts: list[str | None], model: BiLstmCrf | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    looked = [candidates(t) if t else [] for t in texts]
    base = [sorted(s for s, ok in c if ok) for c in looked]
    failed = [[s for s, ok in c if not ok] for c in looked]
    every = [list(b) for b in base]
    if model is not None:
        where = [(i, a, b) for i, t in enumerate(texts) if t for a, b in stretches(t)]
        for (i, a, b), tags in zip(where, model.tag([texts[i][a:b] for i, a, b in where]), strict=True):
            for span in _decoded(texts[i], tags, a, failed[i]):
                touched = any(s[0] < span[2] and span[0] < s[2] for s in every[i])
                if not touched and plausible(span[1], texts[i][span[0]:span[2]]) and not any(
                        _rejects(s, span, texts[i]) for s in failed[i]):
                    every[i].append(span)
    return [(b, sorted(e)) for b, e in zip(base, every, strict=True)]


def personal_data(docs: DataFrame, model: BiLstmCrf | None) -> DataFrame:
    """``docs`` without ``text``, with counts per kind of all spans, of the rules'
    alone (base_email, ...), base_sha256 and spans, which replace columns of
    these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # a fixed number of weights
    schema = StructType([*[StructField(f"{of}_{k}", LongType()) for of in ("n", "base") for k in KINDS],
                         StructField("base_sha256", StringType()), StructField("spans", StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(batch.column("text").to_pylist(), shared.value)
            per_kind = [pa.array([sum(k == s[1] for s in spans) for spans in of], pa.int64())
                        for of in ([e for _, e in found], [b for b, _ in found]) for k in range(len(KINDS))]
            base = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), *per_kind, base, pa.array([written(e) for _, e in found], pa.string())],
                names=["carried", *schema.names])

    return with_results(docs, run, schema)
