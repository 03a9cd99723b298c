"""Personal data: patterns, and a skip-chain conditional random field that carries labels along a document."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import bounded_batches, seeded, with_fields

SEED = 4
#: The field is fitted on at most so many documents.
SAMPLE_DOCS = 20_000
STEPS = 400
#: Messages are passed on until they change by less; where they go on changing for long, this doubles by and by.
SETTLED = 1e-6
PATIENCE = 1000
#: The log potential, before the sample is seen, of two similar words having one label.
AGREE = 6.0
#: A token that no pattern found needs this chance of a label.
SURE = 0.9

KINDS = ("email", "ip", "card", "phone")
NONE, EMAIL, IP, CARD, PHONE = range(5)
LABELS = 5

Span = tuple[int, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match that starts inside a run of digits also starts at the run's begin, so only begins are tried
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@][^\x20\x09-\x0D]*")
_EDGES = "()[]{}<>.,;:!?\"'|*%$#&"
_BLANK = frozenset("\x20\x09\x0a\x0b\x0c\x0d")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the local part before it, not reaching back into the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, label, whether it holds) of all pattern matches; each kind leftmost, without overlap."""
    for start, end in _emails(text):
        yield start, end, EMAIL, True
    if not _DIGITS.search(text):
        return
    for m in _IP.finditer(text):
        yield m.start(), m.end(), IP, all(map(_at_most_255, m[0].split(".")))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            yield m.start(), m.end(), CARD, 14 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield m.start(), m.end(), PHONE, 10 <= len(_DIGITS.findall(m[0])) <= 15


def base_spans(text: str) -> list[Span]:
    """(start, end, label) of what the patterns find, by start, then label."""
    return sorted(((a, b, k) for a, b, k, holds in _matches(text) if holds), key=lambda s: (s[0], s[2]))


def taught(text: str, words: list[tuple[int, int]]) -> list[int]:
    """Labels to learn from: those of the patterns, and -1 for words of matches that were dropped."""
    found = sorted(_matches(text))
    labels = covered(words, [m[:3] for m in found if m[3]])
    dropped = covered(words, [(a, b, PHONE) for a, b, _, holds in found if not holds])
    return [-1 if lost and not label else label for label, lost in zip(labels, dropped, strict=True)]


def candidates(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an @, the only ones that any kind can hold."""
    out: list[tuple[int, int]] = []
    done = 0
    for m in _HINT.finditer(text):
        start = m.start()
        while start > done and text[start - 1] not in _BLANK:
            start -= 1
        out.append((start, m.end()))
        done = m.end()
    return out


def _shape(word: str) -> list[float]:
    core = word.strip(_EDGES)
    digits = "".join(_DIGITS.findall(core))
    parts = core.split(".")
    n = len(digits)
    only = len(core) - n
    local, _, domain = core.partition("@")
    return [
        1.0,
        float("@" in core),
        float(1 <= len(local) <= 64 and "@" not in domain and "." in domain[1:-1]),
        float(len(parts) == 4 and all(p.isdigit() and p.isascii() and _at_most_255(p) for p in parts)),
        float(len(parts) == 4),
        float(14 <= n <= 19 and only <= 4),
        float(14 <= n <= 19 and only <= 4 and luhn(digits)),
        float(word.startswith("+")),
        float(word.startswith("(") and word.rstrip(".,;:").endswith(")")),
        float(n > 0 and only <= 1 and "-" in core),
        float(only == 0),
        float(n <= 3),
        float(4 <= n <= 10),
        float(n > 19),
        float(any(c.isalpha() for c in core)),
    ]


WIDTH = len(_shape("0")) * 3


def _key(word: str) -> str:
    """What similar words share: long numbers by their digits, addresses without edges and case; "" if the word says too little."""
    core = word.strip(_EDGES).lower()
    digits = "".join(_DIGITS.findall(core))
    if len(digits) >= 6 and not any(c.isalpha() for c in core):
        return digits
    return core if "@" in core or len(digits) >= 6 else ""


def graph(text: str, words: list[tuple[int, int]]) -> tuple[list[list[float]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Features, links of neighbouring words, and skip links from a word to its next similar one."""
    shapes = [_shape(text[a:b]) for a, b in words]
    blank = [0.0] * (WIDTH // 3)
    chain = [i for i in range(len(words) - 1) if not text[words[i][1] : words[i + 1][0]].strip("\x20\x09\x0a\x0b\x0c\x0d")]
    after, before = {i: i + 1 for i in chain}, {i + 1: i for i in chain}
    rows = [
        s + (shapes[before[i]] if i in before else blank) + (shapes[after[i]] if i in after else blank)
        for i, s in enumerate(shapes)
    ]
    last: dict[str, int] = {}
    skips = []
    for i, (a, b) in enumerate(words):
        key = _key(text[a:b])
        if key and key in last:
            skips.append((last[key], i))
        last[key] = i
    return rows, [(i, i + 1) for i in chain], skips


def reach(skips: list[tuple[int, int]], known: list[int]) -> list[tuple[int, int]]:
    """Skip links, and one from each open word to the nearest like word that a pattern matched, however many are between.

    A label would get weaker with each open word that it has to pass.
    """
    before: dict[int, int] = {}
    after: dict[int, int] = {}
    for a, b in skips:  # by their second word
        before[b] = a if known[a] else before.get(a, -1)
    for a, b in sorted(skips, reverse=True):
        after[a] = b if known[b] else after.get(b, -1)
    have = set(skips)
    out = list(skips)
    for i in sorted(before.keys() | after.keys()):
        left, right = before.get(i, -1), after.get(i, -1)
        if known[i] or left < 0 and right < 0:
            continue
        link = (left, i) if right < 0 or 0 <= left and i - left <= right - i else (i, right)
        if link not in have:
            out.append(link)
    return out


def covered(words: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """The label of each word: that of the first pattern match that overlaps it."""
    labels, at = [], 0
    by_end = sorted(spans, key=lambda s: s[1])
    for a, b in words:
        while at < len(by_end) and by_end[at][1] <= a:
            at += 1
        labels.append(next((s[2] for s in by_end[at:] if s[0] < b), NONE) if at < len(by_end) else NONE)
    return labels


@dataclass(frozen=True)
class Field:
    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(
        self, x: np.ndarray, chain: np.ndarray, skips: np.ndarray, known: np.ndarray, rounds: int | None = None
    ) -> np.ndarray:
        """Label chances by loopy message passing over all words at once, until no message changes.

        `known` has the labels that patterns have settled (0: open); those words
        keep their label and pass it on. Only links beside a change are worked on again.
        """
        own = x @ self.weights
        held = known > 0
        own[held] = -50.0
        own[held, known[held]] = 0.0
        links = np.concatenate([chain, skips])
        table = np.concatenate([
            np.broadcast_to(self.chain, (len(chain), LABELS, LABELS)),
            np.broadcast_to(self.skip, (len(skips), LABELS, LABELS)),
        ])
        forth, back = np.zeros((len(links), LABELS)), np.zeros((len(links), LABELS))
        belief, live, done = own.copy(), np.arange(len(links)), 0
        while len(live) and done != rounds:
            a, b = links[live].T
            to_right = (belief[a] - back[live])[:, :, None] + table[live]
            to_left = (belief[b] - forth[live])[:, None, :] + table[live]
            more_forth = 0.5 * (_normal(_logsum(to_right, 1)) - forth[live])
            more_back = 0.5 * (_normal(_logsum(to_left, 2)) - back[live])
            forth[live] += more_forth
            back[live] += more_back
            np.add.at(belief, b, more_forth)
            np.add.at(belief, a, more_back)
            done += 1
            # a tree of so many links has settled by then; a loop that swings may not
            least = SETTLED * 2.0 ** (max(done - PATIENCE - 4 * len(links), 0) // 100)
            changed = np.zeros(len(own), bool)
            changed[b[np.abs(more_forth).max(1) > least]] = True
            changed[a[np.abs(more_back).max(1) > least]] = True
            live = np.flatnonzero(changed[links].any(1))
        return np.exp(_normal(belief))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _normal(x: np.ndarray) -> np.ndarray:
    return x - _logsum(x, 1)[:, None]


def fit(x: np.ndarray, chain: np.ndarray, skips: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Field:
    """Pseudo-likelihood: each word's label given its features and its neighbours' labels; -1 teaches nothing."""
    y = np.where(label[:, None] >= 0, np.eye(LABELS)[label], 0.0)

    def seen(links: np.ndarray, to: int) -> np.ndarray:
        out = np.zeros((len(label), LABELS))
        np.add.at(out, links[:, to], y[links[:, 1 - to]])
        return out

    # the skip table is symmetric: which of two similar words comes first does not matter
    sides = [x, seen(chain, 1), seen(chain, 0), seen(skips, 0) + seen(skips, 1)]
    # similar words agree unless the sample says otherwise; it may hold few of them
    prior = [np.zeros((s.shape[1], LABELS)) for s in sides[:2]] + [AGREE * np.eye(LABELS)]
    theta = [p.copy() for p in prior]
    first = [np.zeros_like(t) for t in theta]
    second = [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1 if len(label) else 1):
        w, chained, skip = theta
        odds = sides[0] @ w + sides[1] @ chained + sides[2] @ chained.T + sides[3] @ skip
        miss = np.where(label[:, None] >= 0, y - np.exp(_normal(odds)), 0.0)
        grads = [sides[0].T @ miss, sides[1].T @ miss + miss.T @ sides[2], sides[3].T @ miss]
        grads[2] = (grads[2] + grads[2].T) / 2
        for i, g in enumerate(grads):
            g = g / len(label) - 1e-4 * (theta[i] - prior[i])
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.99 * second[i] + 0.01 * g**2
            theta[i] = theta[i] + 0.1 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Field(*theta)


def added_spans(text: str, words: list[tuple[int, int]], chance: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of words that the field labels and no pattern of that kind covers.

    Neighbouring phone words make one span, which a leading + begins anew.
    """
    out: list[Span] = []
    label = chance.argmax(1)
    label[chance.max(1) < SURE] = NONE
    i = 0
    while i < len(words):
        kind, j = int(label[i]), i + 1
        if kind == PHONE:
            while (
                j < len(words) and label[j] == PHONE and text[words[j][0]] != "+"
                and not text[words[j - 1][1] : words[j][0]].strip()
            ):
                j += 1
        if kind:
            start, end = words[i][0], words[j - 1][1]
            strip = _EDGES.replace("(", "") if kind == PHONE else _EDGES
            start += len(text[start:end]) - len(text[start:end].lstrip(strip))
            end -= len(text[start:end]) - len(text[start:end].rstrip(_EDGES))
            if start < end and not any(a < end and start < b for a, b, _ in base):
                out.append((start, end, kind))
        i = j
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def _pairs(rows: list[tuple[int, int]]) -> np.ndarray:
    return np.array(rows, np.int64).reshape(-1, 2)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, chains, skips, labels = [], [], [], []
        for text in batch.column("text").to_pylist():
            words = candidates(text or "")
            if words:
                rows, chain, skip = graph(text, words)
                xs.append(np.array(rows, np.float32).tobytes())
                chains.append([v for pair in chain for v in pair])
                skips.append([v for pair in skip for v in pair])
                labels.append(taught(text, words))
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(xs, pa.binary()), pa.array(chains, kind), pa.array(skips, kind), pa.array(labels, kind)],
            names=["x", "chain", "skips", "labels"],
        )


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, seed: int = SEED) -> Field:
    """A field from at most `sample` documents, in which the patterns' matches are the labels.

    The sample goes by a seeded hash of the id; null ids are not learnt from.
    Only features and labels of words with a digit or an @ reach the driver.
    """
    bounded_batches(docs.sparkSession)
    drawn = docs.select("doc_id").where("doc_id is not null").distinct()
    drawn = drawn.orderBy(seeded(seed, F.col("doc_id")), "doc_id").limit(sample)
    chosen = docs.join(F.broadcast(drawn), "doc_id").select("text")  # at most `sample` ids
    kind = "x binary, chain array<int>, skips array<int>, labels array<int>"
    rows = chosen.mapInArrow(_sampled, kind).collect()
    rows.sort(key=lambda r: (len(r.labels), bytes(r.x)))
    starts = np.cumsum([0] + [len(r.labels) for r in rows])
    moved = lambda name: _pairs([p for r in rows for p in zip(r[name][::2], r[name][1::2], strict=True)])
    shift = lambda name: np.repeat(starts[:-1], [len(r[name]) // 2 for r in rows])[:, None].astype(np.int64)
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float32).astype(np.float64).reshape(-1, WIDTH)
    label = np.array([v for r in rows for v in r.labels], np.int64)
    return fit(x, moved("chain") + shift("chain"), moved("skips") + shift("skips"), label)


def _finder(field: Field) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                spans = base_spans(text)
                words = candidates(text)
                more: list[Span] = []
                if words:
                    rows, chain, skips = graph(text, words)
                    known = covered(words, spans)
                    linked = _pairs(reach(skips, known))
                    chance = field.marginals(np.array(rows), _pairs(chain), linked, np.array(known, np.int64))
                    more = added_spans(text, words, chance, spans)
                base.append(spans)
                added.append(more)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
            rows_of = lambda many: pa.array(
                [[{"start": a, "end": b, "kind": KINDS[k - 1]} for a, b, k in spans] for spans in many], kind
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rows_of(base), rows_of(added), pa.array([written(s) for s in base]),
                 pa.array([written(s + m) for s, m in zip(base, added, strict=True)])],
                names=[*batch.schema.names, "base", "added", "base_written", "all_written"],
            )

    return find


def find(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with `base` and `added` spans, and both written as kind:start:end in code points.

    Words that hold neither a digit nor an @ can have no label, so the field's
    variables are the others; words side by side share a potential, and so does
    each word with the next similar one of the document and with the nearest one
    that a pattern matched, however distant. A word that a pattern matched keeps
    its label.

    A null text counts as empty and has no spans. Repeated rows are treated
    alike, other columns pass through, columns of the new names are replaced,
    an empty table gives an empty table. Steps are linear in a text's length, and
    messages are worked on as long as they change.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.drop("base", "added", "base_written", "all_written")
    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    schema = with_fields(
        rows.schema, ("base", kind), ("added", kind), ("base_written", "string"), ("all_written", "string")
    )
    return rows.mapInArrow(_finder(field), schema)
