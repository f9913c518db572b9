"""Personal data: fixed patterns, and a skip-chain conditional random field over every other candidate token.

A candidate is a token with a digit or an at sign; other tokens belong to no entity. Candidates side by side form chains.
Tokens of a document that repeat, or have the same digits or mail domain, are linked at any distance. Both kinds of links
carry potentials over the labels of their ends, and loopy message passing settles the labels of a document together: what
the patterns found in one place speaks for its like elsewhere.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bytes_of, map_texts, row_chunks, split_text, strings, text_rows

# The base patterns, their order, and what a match must satisfy (digits of a card and a phone). The forms
# below never try a start again that cannot succeed, so that long runs cost no more than their length.
KINDS = ["email", "ip", "card", "phone"]
LOCAL, DOMAIN = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
EMAIL = re.compile(rf"{LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++")
EMAIL_RUN = re.compile(rf"(?<!{LOCAL}){EMAIL.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (16, 19), (8, 15), 255

OUT = "crf_"            # spans that the field adds are of kinds crf_email, ...
LABELS = 1 + len(KINDS)
SLOTS = 1 << 13         # feature weights of each label
SAMPLE_DOCS = 2_000     # documents that the field is fitted to, at most
SAMPLE_TOKENS = 200     # candidate tokens of such a document, at most
STEPS, ROUNDS = 120, 15
REPEAT = 6              # characters, or digits, of a token that is linked to its repeats
PULL = 6.0              # log odds by which a link favours equal labels before training
SURE = 0.9              # marginal probability of a label that is given
CHUNK = 1 << 22
NOT_DIGIT = re.compile(r"[^0-9]+")
DIGIT_RUN = re.compile(r"[0-9]+")
EDGES = "\"'`.,;:!?<>[]{}()*#$%&=~|/\\_^-"
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SIGNS = np.isin(np.arange(256), [*range(0x30, 0x3A), 0x40])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def is_address(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= IP_PART for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    found = []
    if "@" in text:
        at = 0
        while m := EMAIL.match(text, at) or EMAIL_RUN.search(text, at):
            found.append((0, m.start(), m.end()))
            at = m.end()
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if is_address(m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = NOT_DIGIT.sub("", m.group())
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(NOT_DIGIT.sub("", m.group())) <= PHONE_DIGITS[1]:
                found.append((3, m.start(), m.end()))
    return found


def shape_of(token: str, exact: bool = False) -> str:
    """Letters as x, digits as d; runs as one sign, or runs of digits as their length."""
    digits = DIGIT_RUN.sub(lambda m: f"<{min(len(m.group()), 20)}>" if exact else "\1", token)
    return re.sub(r"[^\W\d_]+", "x", digits).replace("\1", "d")


def features_of(token: str, before: str, after: str) -> list[int]:
    """Places of the weights that a token has a part in."""
    digits = NOT_DIGIT.sub("", token)
    parts = token.split(".")
    near = [shape_of(t.strip(EDGES)) if any(c.isdigit() or c == "@" for c in t) else "" for t in (before, after)]
    values = [
        "", shape_of(token), shape_of(token, True), str(min(len(digits), 20)),
        f"{min(len(digits), 20)} {luhn(digits)}" if len(digits) > 11 else "",
        f"{len(parts)} {is_address(parts)}" if all(p.isdigit() and p.isascii() for p in parts) else "",
        near[0], near[1], before.strip(EDGES).lower() if not near[0] else "", f"{token[:1]} {'@' in token}"]
    return [zlib.crc32(f"{i}:{v}".encode("utf-8", "surrogatepass")) % SLOTS for i, v in enumerate(values)]


FEATURES = len(features_of("1", "", ""))


@dataclass
class Field:
    """Candidate tokens of some documents and the links among them."""
    doc: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)          # 0: open; 1, ...: a base pattern has it
    features: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, doc: int, text: str, data: np.ndarray, base: list[tuple[int, int, int]]) -> None:
        """The candidates of a text, whose UTF-8 bytes are ``data``."""
        first = len(self.doc)
        edge = np.diff(np.r_[0, (~SPACE[data]).view(np.int8), 0])
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.unique(np.searchsorted(begins, np.flatnonzero(SIGNS[data]), "right") - 1)
        if len(text) < len(data):
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            begins, ends = points[begins], points[ends]

        def token(k: int) -> str:
            return text[begins[k]:ends[k]] if 0 <= k < len(begins) else ""

        last: dict[tuple, int] = {}
        previous = None
        links = set()
        for k in at.tolist():
            raw = token(k)
            core = raw.lstrip(EDGES)
            a = int(begins[k]) + len(raw) - len(core)
            core = core.rstrip(EDGES)
            b = a + len(core)
            if not core:
                continue
            n = len(self.doc)
            self.doc.append(doc)
            self.start.append(a)
            self.end.append(b)
            self.label.append(0)
            self.features.append(features_of(core, token(k - 1), token(k + 1)))
            if previous is not None and not text[previous:a].strip(EDGES + " \t\n\v\f\r"):
                self.chain.append((n - 1, n))
            previous = b
            digits = NOT_DIGIT.sub("", core)
            keys = [("same", core.lower())] if len(core) >= REPEAT else []
            keys += [("digits", digits)] if len(digits) >= REPEAT else []
            keys += [("mail", core[core.rindex("@"):].lower())] if "@" in core and core[-1] != "@" else []
            for key in keys:
                if key in last:
                    links.add((last[key], n))
                last[key] = n
        label_spans(self, range(first, len(self.doc)), base)
        self.skip += sorted(links)

    def arrays(self):
        as_links = lambda x: np.array(x, np.int64).reshape(-1, 2)
        return (np.array(self.features, np.int64).reshape(-1, FEATURES), np.array(self.label, np.int64),
                as_links(self.chain), as_links(self.skip))


def label_spans(field_: Field, nodes, base: list[tuple[int, int, int]]) -> None:
    """Give each token the first kind whose spans meet it."""
    for kind in range(len(KINDS)):
        spans = [(s, e) for k, s, e in base if k == kind]
        starts, ends = np.array([s for s, _ in spans]), np.array([e for _, e in spans])
        for n in nodes:
            i = int(np.searchsorted(ends, field_.start[n], "right")) if len(spans) else 0
            if not field_.label[n] and i < len(spans) and starts[i] < field_.end[n]:
                field_.label[n] = kind + 1


@dataclass
class Model:
    weights: np.ndarray  # SLOTS x LABELS
    chain: np.ndarray    # LABELS x LABELS
    skip: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Messages:
    """Loopy message passing over the links of a field, in logarithms; both ways of each link at once."""

    def __init__(self, nodes: int, chain: np.ndarray, skip: np.ndarray):
        both = np.concatenate([chain, skip])
        self.nodes, self.first = nodes, len(chain)
        self.a, self.b = both[:, 0], both[:, 1]
        self.forth = np.zeros((len(both), LABELS))
        self.back = np.zeros((len(both), LABELS))

    def potentials(self, model: Model) -> np.ndarray:
        return np.concatenate([np.broadcast_to(model.chain, (self.first, LABELS, LABELS)),
                               np.broadcast_to(model.skip, (len(self.a) - self.first, LABELS, LABELS))])

    def beliefs(self, unary: np.ndarray) -> np.ndarray:
        total = unary.copy()
        np.add.at(total, self.b, self.forth)
        np.add.at(total, self.a, self.back)
        return total

    def run(self, unary: np.ndarray, model: Model, rounds: int) -> np.ndarray:
        """Marginal probabilities of the nodes after some rounds, each message moving half of its way."""
        if len(self.a):
            potentials = self.potentials(model)
            for _ in range(rounds):
                total = self.beliefs(unary)
                forth = log_sum((total[self.a] - self.back)[:, :, None] + potentials, 1)
                back = log_sum((total[self.b] - self.forth)[:, None, :] + potentials, 2)
                self.forth += 0.5 * (forth - log_sum(forth, 1)[:, None] - self.forth)
                self.back += 0.5 * (back - log_sum(back, 1)[:, None] - self.back)
        total = self.beliefs(unary)
        return np.exp(total - log_sum(total, 1)[:, None])

    def links(self, unary: np.ndarray, model: Model) -> np.ndarray:
        """Expected pairs of labels over the chain links and over the skip links."""
        if not len(self.a):
            return np.zeros((2, LABELS, LABELS))
        total = self.beliefs(unary)
        x = (total[self.a] - self.back)[:, :, None] + (total[self.b] - self.forth)[:, None, :] + self.potentials(model)
        x = np.exp(x - x.max((1, 2), keepdims=True))
        x /= x.sum((1, 2), keepdims=True)
        return np.stack([x[:self.first].sum(0), x[self.first:].sum(0)])


def held(unary: np.ndarray, labels: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Unary potentials with the known labels fixed."""
    fixed = np.where(known[:, None] & (labels[:, None] != np.arange(LABELS)), -60.0, 0.0)
    return unary + fixed


def train(features: np.ndarray, labels: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = STEPS,
          rate: float = 0.1, decay: float = 0.02) -> Model:
    """Fit the field: the gradient is the difference of the expectations with known labels fixed and with all open.

    Spans of the patterns are known, other candidates are known to be none, but for those linked to a span of a pattern:
    they may well be what they are linked to, and stay open. Skip links start from a pull towards equal labels.
    """
    to_span = np.zeros(len(labels), bool)
    to_span[skip[labels[skip[:, 1]] > 0, 0]] = True
    to_span[skip[labels[skip[:, 0]] > 0, 1]] = True
    known = (labels > 0) | ~to_span
    pull = PULL * np.eye(LABELS)
    model = Model(np.zeros((SLOTS, LABELS)), np.zeros((LABELS, LABELS)), pull.copy())
    parts = [model.weights, model.chain, model.skip]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    open_, fixed = Messages(len(labels), chain, skip), Messages(len(labels), chain, skip)
    for step in range(1, steps + 1):
        unary = model.weights[features].sum(1)
        want, have = fixed.run(held(unary, labels, known), model, 3), open_.run(unary, model, 3)
        to_weights = np.zeros_like(model.weights)
        np.add.at(to_weights, features.ravel(), np.repeat(want - have, FEATURES, 0))
        links = fixed.links(held(unary, labels, known), model) - open_.links(unary, model)
        # A skip link has no direction.
        gradients = [to_weights - decay * model.weights, links[0] - decay * model.chain,
                     (links[1] + links[1].T) / 2 - decay * (model.skip - pull)]
        for p, g, m, s in zip(parts, gradients, means, squares):
            m += 0.1 * (g - m)
            s += 0.001 * (np.square(g) - s)
            p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return model


def added_spans(found: Field, model: Model | None, sure: float) -> dict[int, list[tuple[int, int, int]]]:
    """(kind, start, end) by document of what the field finds outside the patterns: runs of open candidates that follow each
    other and have the same sure label."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    if model is None or not found.doc:
        return out
    features, labels, chain, skip = found.arrays()
    unary = held(model.weights[features].sum(1), labels, labels > 0)
    chance = Messages(len(labels), chain, skip).run(unary, model, ROUNDS)
    best = chance.argmax(1)
    taken = (labels == 0) & (best > 0) & (chance.max(1) >= sure)
    follows = np.zeros(len(labels), bool)
    follows[chain[:, 1]] = True
    last = -2
    for n in np.flatnonzero(taken).tolist():
        spans = out[found.doc[n]]
        if follows[n] and last == n - 1 and best[n] == best[last]:
            spans[-1] = (spans[-1][0], spans[-1][1], found.end[n])
        else:
            spans.append((len(KINDS) + int(best[n]) - 1, found.start[n], found.end[n]))
        last = n
    return out


def read_texts(column: pa.Array):
    """(row, text, bytes, base spans) of the texts with a digit or an at sign."""
    data, starts = bytes_of(column)
    texts = strings(column)
    for a, b in row_chunks(starts, CHUNK):
        part = data[starts[a]:starts[b]]
        rows = np.unique(np.searchsorted(starts[a:b + 1] - starts[a], np.flatnonzero(SIGNS[part]), "right") - 1)
        for row in (rows + a).tolist():
            yield row, texts[row], data[starts[row]:starts[row + 1]], base_spans(texts[row])


def sample_of(docs: DataFrame, most: int, tokens: int):
    """(features, labels, chain links, skip links) of a bounded draw of different texts with candidates, the first by a hash."""
    def run(batches):
        for batch in batches:
            prints = batch.column(1)
            rows = []
            for row, text, data, base in read_texts(batch.column(0)):
                one = Field()
                if SIGNS[data].sum() <= 32 * tokens:
                    one.add(row, text, data, base)
                if 0 < len(one.doc) <= tokens:
                    features, labels, chain, skip = one.arrays()
                    rows.append((prints[row].as_py(), *(x.ravel().tolist() for x in (features, labels, chain, skip))))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in columns[1:])],
                ["print", "features", "labels", "chain", "skip"])

    some = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("print"))
    drawn = map_texts(some, run, "print long, features array<long>, labels array<long>, chain array<long>, skip array<long>")
    parts, nodes = [], 0
    for r in drawn.dropDuplicates(["print"]).orderBy("print").limit(most).collect():
        n = len(r["labels"])
        parts.append((np.array(r["features"]).reshape(n, -1), np.array(r["labels"]),
                      *(np.array(r[c], np.int64).reshape(-1, 2) + nodes for c in ("chain", "skip"))))
        nodes += n
    return [np.concatenate(x) for x in zip(*parts)] if parts else None


def fit(docs: DataFrame, most: int = SAMPLE_DOCS, tokens: int = SAMPLE_TOKENS) -> Model | None:
    """The field fitted to the findings of the patterns, or None where they find nothing."""
    drawn = sample_of(docs, most, tokens)
    return train(*drawn) if drawn and drawn[1].any() else None


def scan(docs: DataFrame, keep: list[str] | None = None, sure: float = SURE, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Find personal data in every whole text.

    Returns the columns of ``keep`` (doc_id by default) and three arrays in order of kind, then start: kinds (positions in
    KINDS, then again for spans that the field adds), starts, ends, in code points, ends exclusive. Spans of the fixed
    patterns are always there. The field labels the other candidate tokens of a document, with those spans as given, and
    adds runs of tokens whose marginal probability of a label is at least ``sure``. Without any span of a pattern in the
    corpus there is nothing to learn from, and the field adds nothing.

    Null and empty texts have empty arrays; texts of any length are read whole; repeated rows each get their row; columns
    named like results are refused in ``keep``; an empty table gives an empty one. The field is fitted to at most
    ``sample`` different documents, of at most SAMPLE_TOKENS candidates each.
    """
    keep = ["doc_id"] if keep is None else keep
    clash = {"kinds", "starts", "ends", "text_to_read"} & set(keep)
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    model = fit(docs, sample)

    def run(batches):
        for batch in batches:
            text, carried, kept = split_text(batch)
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            found = Field()
            for row, words, data, base in read_texts(text):
                spans[row] += base
                found.add(row, words, data, base)
            for row, more in added_spans(found, model, sure).items():
                spans[row] += sorted(more)
            yield pa.RecordBatch.from_arrays(
                [*carried, *(pa.array([[s[i] for s in row] for row in spans], pa.list_(pa.int32())) for i in range(3))],
                [*kept, "kinds", "starts", "ends"])

    rows, schema = text_rows(docs, keep)
    return map_texts(rows, run, f"{schema}, kinds array<int>, starts array<int>, ends array<int>")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds and of what the field adds, base_sha256, spans as text."""
    found = scan(docs)
    names = F.array(*[F.lit(k) for k in [*KINDS, *(OUT + k for k in KINDS)]])
    rows = F.arrays_zip("kinds", "starts", "ends")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kinds"] + 1), x["starts"].cast("string"), x["ends"].cast("string"))), ",")

    def count(k: int):
        return F.size(F.filter("kinds", lambda x: x == k)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)], F.sha2(joined(F.filter(rows, lambda x: x["kinds"] < len(KINDS))).cast("binary"), 256).alias("base_sha256"),
        joined(rows).alias("spans"), F.size(F.filter("kinds", lambda x: x >= len(KINDS))).cast("long").alias("n_crf"))
