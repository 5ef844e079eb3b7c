"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find e-mail and IP addresses, card and phone numbers; what they find stays. The field labels
whitespace-separated words by their shape and their neighbours' shape and adds spans in other writings
(`name [at] host dot org`, `(030) 1234 5678`). It is trained here, from the labelled lines of
`pii_lines.LINES` or another small table of that form. Words that hold neither digit nor `@` and stand
away from a written-out `[at]` or `dot` can only be outside, so a text falls apart into short
chains; these are decoded together, step by step, by Viterbi in numpy.

Defined cases: null texts are empty and have no spans. An added span that meets a pattern's span, or
that lacks the digits or parts its kind needs, is dropped. Redaction replaces touching spans of
different kinds once, by the kind that starts first.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.pii_lines import LINES
from alertloom.llm.text import append_columns, columns_of, free_prefix

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int]

# Fixed patterns of the four kinds, written so that no long run of characters is read again and again.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _emails(text: str) -> list[Span]:
    """As the leftmost pattern match would: from each @ to the left, up to the span before."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def _ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if _is_ip(m.group())]


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number holds: every second digit from the right counts double."""
    values = [int(d) for d in reversed(digits)]
    doubled = [sum(divmod(2 * v, 10)) for v in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _is_card(s: str) -> bool:
    d = _digits(s)
    return 13 <= len(d) <= 19 and luhn(d)


def _cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and _is_card(m.group())]


def _phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]


def base_spans(text: str) -> list[list[Span]]:
    """The patterns' spans for each of KINDS, as code points."""
    numbers = _DIGIT.search(text) is not None
    return [
        _emails(text) if "@" in text else [],
        _ips(text) if numbers and "." in text else [],
        _cards(text) if numbers else [],
        _phones(text) if numbers and "+" in text else [],
    ]


# The field. State 0 is outside; kind k begins at 1 + 2k and goes on at 2 + 2k.
STATES = 1 + 2 * len(KINDS)
_CUES = {"[at]": "at", "(at)": "at", "<at>": "at", "{at}": "at", "[dot]": "dot", "(dot)": "dot", "<dot>": "dot", "{dot}": "dot", "dot": "dot"}
_OPEN = re.compile(r"[0-9@]|[\[(<{](?:at|dot)[\])>}]|(?<![^\x20\x09-\x0D])dot(?![^\x20\x09-\x0D])", re.I)
_REACH = 3


# Marks at a word's ends that belong to the sentence.
_AROUND = ".,;:!?\"'"


_DIGITS = re.compile("[0-9]+")
# Disguised signs within a word.
_INSIDE = re.compile(r"[\[(<{](at|dot|\.)[\])>}]")
# Lengths of runs of digits in a shape.
_LENGTHS = re.compile("9[1-4]")


def _cue(word: str) -> str | None:
    return _CUES.get(word.lower())


def shape(word: str) -> str:
    """Runs of digits, lower and upper case letters as one character and their length up to 4; the rest as it is."""
    if cue := _cue(word):
        return cue
    word = word.strip(_AROUND)
    out: list[str] = []
    run = 0
    for c in word:
        kind = "9" if c in "0123456789" else "a" if c.islower() else "A" if c.isupper() else c
        if out and out[-1] == kind:
            run += 1
            continue
        if out and run:
            out.append(str(min(run, 4)) if out[-1] == "9" else "")
        out.append(kind)
        run = 1
    if out and run:
        out.append(str(min(run, 4)) if out[-1] == "9" else "")
    return "".join(out)


def _plain(word: str) -> str:
    """A word of letters for its meaning: lower case, without the sentence's marks. Others are all alike."""
    word = word.strip(_AROUND).lower()
    return word if word.isalpha() else "9" if _DIGIT.search(word) else ""


def _features(word: str, before: str, after: str, earlier: tuple[str, str] = ("", "")) -> list[str]:
    """Features of a word between its neighbours; `earlier` are the two words in front of `before`."""
    digits = len(_digits(word))
    mine, left, right = shape(word), shape(before), shape(after)
    return [
        "bias",
        f"s={mine}",
        f"z={_LENGTHS.sub('9', mine)}",
        f"n={min(digits, 17)}",
        f"g={min(len(_DIGITS.findall(word)), 5)}{'.' in word}",
        f"m={','.join(sorted(set(_INSIDE.findall(word.lower()))))}",
        f"f={mine[:1]}",
        f"l={mine[-1:]}",
        f"d={digits > 0}{before[:1] == '('}{word[:1] in '(+0'}",
        f"p={left}",
        f"q={right}",
        f"ps={left}|{mine}",
        f"sq={mine}|{right}",
        f"e={word[-1:] in _AROUND}",
        f"pd={bool(_DIGIT.search(before))}{bool(_DIGIT.search(after))}",
        # One of the three words in front, wherever it stands.
        *[f"b={_plain(w)}" for w in (*earlier, before)],
        f"v={_plain(after)}",
    ]


@dataclass
class Chain:
    """Neighbouring open words of a text: their places, and the features of each."""

    text: int
    places: list[Span]
    features: list[list[str]]


def chains(number: int, text: str) -> list[Chain]:
    """The open words of a text in maximal runs, each with its neighbours' shapes."""
    if not _OPEN.search(text):
        return []
    spots = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    is_open = np.zeros(len(spots), bool)
    starts = np.array([s for s, _ in spots])
    hits = [m.start() for m in _OPEN.finditer(text)]
    at = np.unique(np.searchsorted(starts, hits, side="right") - 1)
    is_open[at] = True
    for i in at.tolist():
        if _cue(text[spots[i][0] : spots[i][1]]):
            is_open[max(0, i - _REACH) : i + _REACH + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], is_open, [False]])))
    out = []
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
        ahead = min(3, low)
        words = [""] * (3 - ahead) + [text[a:b] for a, b in spots[low - ahead : high + 1]]
        words += [""] if high == len(spots) else []
        features = [
            _features(words[i], words[i - 1], words[i + 1], (words[i - 3], words[i - 2])) for i in range(3, len(words) - 1)
        ]
        out.append(Chain(number, spots[low:high], features))
    return out


@dataclass
class Field:
    """Weights of features (a row each) for every state, and of one state after another."""

    names: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def scores(self, features: list[str]) -> np.ndarray:
        known = [self.names[f] for f in features if f in self.names]
        return self.emit[known].sum(axis=0)

    def decode(self, found: list[Chain]) -> list[np.ndarray]:
        """The best states of each chain. Chains of similar length go step by step together."""
        out: list[np.ndarray] = [None] * len(found)
        order = sorted(range(len(found)), key=lambda i: len(found[i].places))
        while order:
            longest = len(found[order[-1]].places)
            cut = len(order)
            while cut and len(found[order[cut - 1]].places) * 2 > longest and (len(order) - cut) * longest < 200_000:
                cut -= 1
            group, order = order[cut:], order[:cut]
            lengths = np.array([len(found[i].places) for i in group])
            e = np.zeros((longest, len(group), STATES))
            for j, i in enumerate(group):
                e[: lengths[j], j] = [self.scores(f) for f in found[i].features]
            for j, states in enumerate(viterbi(e, lengths, self.move)):
                out[group[j]] = states
        return out


def viterbi(e: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> list[np.ndarray]:
    """Best paths from outside to outside. `e` has a score for each step, chain and state."""
    steps, n, _ = e.shape
    back = np.zeros(e.shape, np.int8)
    score = e[0] + move[0]
    for t in range(1, steps):
        through = score[:, :, None] + move
        back[t] = through.argmax(axis=1)
        score = np.where((t < lengths)[:, None], through.max(axis=1) + e[t], score)
    state = (score + move[:, 0]).argmax(axis=1)
    path = np.zeros((steps, n), np.int8)
    rows = np.arange(n)
    for t in range(steps - 1, -1, -1):
        path[t] = state
        state = np.where((t < lengths) & (t > 0), back[t, rows, state], state)
    return [path[:length, j] for j, length in enumerate(lengths.tolist())]


def _allowed() -> np.ndarray:
    """A state goes on only after the same kind began or went on."""
    ok = np.ones((STATES, STATES), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


def _states_of(chain: Chain, marked: list[tuple[int, int, int]]) -> list[int]:
    out = []
    for a, b in chain.places:
        hit = next(((k, s) for k, s, e in marked if a < e and b > s), None)
        out.append(0 if hit is None else 1 + 2 * hit[0] + (hit[1] < a))
    return out


def parse_line(line: str) -> tuple[str, list[tuple[int, int, int]]]:
    """A labelled line, `call {phone:030 123456}`, as its text and (kind, start, end)."""
    text, marked, at = "", [], 0
    for m in re.finditer(r"\{(\w+):([^{}]*)\}", line):
        if m[1] not in KINDS:
            continue
        text += line[at : m.start()]
        marked.append((KINDS.index(m[1]), len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + line[at:], marked


def train(lines: list[str] = LINES, rounds: int = 120, rate: float = 0.5, penalty: float = 0.02) -> Field:
    """Weights of highest penalised likelihood for the labelled lines, by adaptive gradient steps."""
    data: list[tuple[Chain, list[int]]] = []
    for line in lines:
        text, marked = parse_line(line)
        data += [(c, _states_of(c, marked)) for c in chains(0, text)]
    names: dict[str, int] = {}
    for c, _ in data:
        for f in c.features:
            for x in f:
                names.setdefault(x, len(names))
    steps, n = max(len(c.places) for c, _ in data), len(data)
    lengths = np.array([len(c.places) for c, _ in data])
    ids = np.zeros((steps, n, len(data[0][0].features[0])), np.int64)
    gold = np.zeros((steps, n), np.int64)
    for j, (c, states) in enumerate(data):
        for t, f in enumerate(c.features):
            ids[t, j] = [names[x] for x in f]
            gold[t, j] = states[t]
    inside = np.arange(steps)[:, None] < lengths
    wall = np.where(_allowed(), 0.0, -1e6)
    emit, move = np.zeros((len(names), STATES)), np.zeros((STATES, STATES))
    emit_past, move_past = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    seen_move = np.zeros_like(move)
    before = np.vstack([np.zeros((1, n), np.int64), gold[:-1]])
    np.add.at(seen_move, (before[inside], gold[inside]), 1)
    np.add.at(seen_move, (gold[lengths - 1, np.arange(n)], np.zeros(n, np.int64)), 1)
    for _ in range(rounds):
        marginal, pairs = _marginals(emit[ids].sum(axis=2), lengths, move + wall)
        gap = -marginal
        np.add.at(gap, (*np.nonzero(inside), gold[inside]), 1)
        gap[~inside] = 0
        flat, width = ids[inside].ravel(), ids.shape[2]
        sums = [np.bincount(flat, np.repeat(gap[inside][:, s], width), len(names)) for s in range(STATES)]
        emit_step = np.stack(sums, axis=1) - penalty * emit
        move_step = seen_move - pairs - penalty * move
        emit_past += emit_step**2
        move_past += move_step**2
        emit += rate * emit_step / np.sqrt(emit_past)
        move += rate * move_step / np.sqrt(move_past)
    return Field(names, emit, move + wall)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _marginals(e: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State probabilities of each step and chain, and expected numbers of moves between states."""
    steps, n, _ = e.shape
    ahead, behind = np.zeros_like(e), np.zeros_like(e)
    ahead[0] = e[0] + move[0]
    for t in range(1, steps):
        ahead[t] = e[t] + _logsum(ahead[t - 1][:, :, None] + move, 1)
    for t in range(steps - 1, -1, -1):
        last = (t == lengths - 1)[:, None]
        later = move[:, 0] if t == steps - 1 else _logsum(move + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        behind[t] = np.where(last, move[:, 0], later)
    total = _logsum(ahead[lengths - 1, np.arange(n)] + move[:, 0], 1)
    inside = np.arange(steps)[:, None] < lengths
    marginal = np.where(inside[:, :, None], np.exp(np.minimum(ahead + behind - total[:, None], 0)), 0)
    pairs = np.zeros_like(move)
    pairs[0] += marginal[0].sum(axis=0)
    for t in range(1, steps):
        joint = ahead[t - 1][:, :, None] + move + (e[t] + behind[t])[:, None, :] - total[:, None, None]
        pairs += np.exp(np.minimum(joint[t < lengths], 0)).sum(axis=0)
    pairs[:, 0] += marginal[lengths - 1, np.arange(n)].sum(axis=0)
    return marginal, pairs


def _trimmed(text: str, start: int, end: int) -> Span:
    """Without punctuation around it; a leading + or ( belongs to a number."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def _plausible(kind: int, s: str) -> bool:
    d = _digits(s)
    if kind == 0:
        return bool(re.search(r"@|\bat\b", s, re.I)) and bool(re.search(r"\.|\bdot\b", s, re.I))
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return _is_card(s)
    return 7 <= len(d) <= 15


def find_spans(texts: list[str], model: Field) -> list[tuple[list[list[Span]], list[list[Span]]]]:
    """For each text: the patterns' spans by kind, and these with the field's."""
    base = [base_spans(t) for t in texts]
    found = [c for i, t in enumerate(texts) for c in chains(i, t)]
    added: list[list[list[Span]]] = [[[] for _ in KINDS] for _ in texts]
    for chain, states in zip(found, model.decode(found)):
        states = states.tolist()
        i = 0
        while i < len(states):
            if not states[i]:
                i += 1
                continue
            kind, j = (states[i] - 1) // 2, i + 1
            while j < len(states) and states[j] == 2 + 2 * kind:
                j += 1
            text = texts[chain.text]
            start, end = _trimmed(text, chain.places[i][0], chain.places[j - 1][1])
            taken = (s for spans in base[chain.text] for s in spans)
            if _plausible(kind, text[start:end]) and not any(start < b and end > a for a, b in taken):
                added[chain.text][kind].append((start, end))
            i = j
    return [(b, [sorted(x + y) for x, y in zip(b, a)]) for b, a in zip(base, added)]


def _joined(spans: list[list[Span]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, s in enumerate(spans) for a, b in s)


def redact(text: str, spans: list[list[Span]]) -> str:
    """The text with each span replaced by its kind, `<EMAIL>`; overlapping spans once."""
    marks = sorted((a, -b, k) for k, s in enumerate(spans) for a, b in s)
    out, at = [], 0
    for a, b, k in marks:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def find_private(docs: DataFrame, model: Field | None = None, prefix: str = "") -> DataFrame:
    """Every row of `docs` with the patterns' counts, base_sha256, spans and the redacted text."""
    model = model or train()
    fields = T.StructType(
        [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted")]
    )

    def compute(batch):
        column = batch.column("text").cast(pa.large_string()).fill_null("")
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, spans, redacted = [], [], []
        for low in range(0, len(column), 256):
            texts = column.slice(low, 256).to_pylist()
            for text, (base, every) in zip(texts, find_spans(texts, model)):
                for k, s in enumerate(base):
                    counts[k].append(len(s))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
                redacted.append(redact(text, every))
        return [*counts, digests, spans, redacted]

    return append_columns(docs, fields, compute, prefix)


def private_data(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """Per document: n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    return find_private(docs.select("doc_id", "text"), model).drop("text", "redacted")


def redact_documents(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """The rows of `docs` with personal data replaced in text, null texts as they are, and n_chars renewed."""
    prefix = free_prefix(docs)
    found = find_private(docs, model, prefix)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(f"{prefix}redacted"))
    renewed = {"text": text}
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(text)
        renewed["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return found.withColumns(renewed).select(*columns_of(docs))
