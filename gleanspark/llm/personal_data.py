"""Personal data: exact base patterns, and a skip-chain conditional random field over what looks like it.

Sites are the stretches of a text that look like numbers or addresses. Each has
a label (none, email, ip, card, phone). Neighbouring sites share a potential, and
so do sites that repeat each other or are alike, however far apart and however they
are punctuated: the skip edges, which link each occurrence with the next one. Alike
are numbers with the same first or last eight digits, such as one with and one
without the code of its country, and addresses with the same name. Loopy
message passing makes the labels of a document consistent. The weights are
fitted by pseudo-likelihood on a bounded sample of documents, in which the base
patterns are the labels.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import read_texts

#: Fixed order of the kinds; ``LABELS`` are those of the field.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents that the weights are fitted on.
SAMPLE_ROWS = 2000
#: Message-passing rounds, and the marginal from which a site becomes a span.
ROUNDS = 8
MIN_MARGINAL = 0.9
#: Neighbouring sites no further apart than this share a potential.
NEAR = 80
#: Prior mean of the weight for equal labels at the two ends of a skip edge.
SKIP_PRIOR = 1.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from within a run of digits would start at its head as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20()./_-]{0,2}[0-9])+")
_TOKEN = re.compile(r"\S+")
#: Digits from which a number is a site.
_SITE_DIGITS = 9
#: Digits at either end that make two numbers alike.
_ALIKE_DIGITS = 8
_FEATURES = 17


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The run before each @ is followed to its head, so long runs without one cost nothing.
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns, by start and kind."""
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # Leading zeros may be more than int() takes.
            parts = [part.lstrip("0") for part in m.group().split(".")]
            if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = _digits(m.group()) if m.end() - m.start() <= 37 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


@dataclass
class Sites:
    """The sites of some documents: spans, features, base labels (-1: none of the patterns fits), and edges."""

    owner: list[int]
    spans: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _site_features(text: str, digits: str) -> list[float]:
    n = len(digits)
    at = "@" in text
    return [
        1.0,
        at,
        at and _DOMAIN.search(text, text.index("@")) is not None,
        bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", text)),
        text[0] == "+",
        "(" in text,
        12 <= n <= 19 and luhn(digits),
        n < 9,
        9 <= n <= 11,
        12 <= n <= 15,
        n == 16,
        17 <= n <= 19,
        n > 19,
        " " in text,
        "-" in text,
        "." in text,
        "/" in text or "_" in text,
    ]


def find_sites(texts: list[str], bases: list[list[tuple[int, int, str]]]) -> Sites:
    owner, spans, features, labels, chain, skip = [], [], [], [], [], []
    for row, (text, base) in enumerate(zip(texts, bases)):
        found = [(a, b, k) for a, b, k in base]
        taken = [(a, b) for a, b, _ in base]
        if "@" in text:
            found += [(m.start(), m.end(), None) for m in _TOKEN.finditer(text) if "@" in m.group()]
        if _DIGIT.search(text):
            found += [(m.start(), m.end(), None) for m in _NUMBER.finditer(text)]
        taken.sort()
        starts, reach = [a for a, _ in taken], []
        for a, b in taken:
            reach.append(max(b, reach[-1] if reach else 0))
        last: dict[str, int] = {}
        before = None
        seen_to = -1
        for a, b, kind in sorted(found, key=lambda s: (s[0], s[2] is None, -s[1])):
            if kind is None:
                i = bisect_left(starts, b) - 1
                # What a base span touches is that span's site; what an earlier site covers is part of it.
                if (i >= 0 and reach[i] > a) or a < seen_to:
                    continue
            digits = _digits(text[a:b]) if b - a <= 64 else ""
            at = "@" in text[a:b]
            if kind is None and not at and not _SITE_DIGITS <= len(digits) <= 40:
                continue
            seen_to = max(seen_to, b)
            place = len(spans)
            owner.append(row)
            spans.append((a, b))
            features.append(_site_features(text[a:b][:200], digits))
            labels.append(LABELS.index(kind) if kind else 0)
            key = "".join(c for c in text[a : min(b, a + 200)].lower() if c.isalnum()) if at else digits
            alike = [f"@{key_name}"] if at and (key_name := text[a:b].split("@", 1)[0][:200].lower()) else []
            if not at and len(digits) >= _SITE_DIGITS:
                alike = [f"{digits[:_ALIKE_DIGITS]}*", f"*{digits[-_ALIKE_DIGITS:]}"]
            # One edge to each earlier site, whatever they have in common.
            skip += [(earlier, place) for earlier in sorted({last[k] for k in (key, *alike) if k in last})]
            last |= dict.fromkeys((key, *alike), place)
            if before is not None and a - spans[before][1] <= NEAR:
                chain.append((before, place))
            before = place
    return Sites(
        owner,
        spans,
        np.array(features, dtype=np.float64).reshape(-1, _FEATURES),
        np.array(labels, dtype=np.int64),
        np.array(chain, dtype=np.int64).reshape(-1, 2),
        np.array(skip, dtype=np.int64).reshape(-1, 2),
    )


@dataclass(frozen=True)
class SkipChain:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, sites: Sites, rounds: int = ROUNDS) -> np.ndarray:
        """Label marginals of each site, by loopy sum-product with both directions of every edge at once."""
        n = len(sites.spans)
        own = sites.features @ self.unary
        edges = np.concatenate((sites.chain, sites.skip))
        if not len(edges):
            return _softmax(own)
        pair = np.concatenate((np.repeat(self.chain[None], len(sites.chain), 0), np.repeat(self.skip[None], len(sites.skip), 0)))
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        back = np.roll(np.arange(len(source)), len(edges))
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(rounds):
            belief = own.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + pair
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            # Half of the old message damps loops.
            messages = 0.5 * messages + 0.5 * (new - new.mean(axis=1, keepdims=True))
        belief = own.copy()
        np.add.at(belief, target, messages)
        assert len(belief) == n
        return _softmax(belief)


def _softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=1, keepdims=True)) if len(logits) else logits
    return grown / grown.sum(axis=1, keepdims=True) if len(logits) else grown


def _neighbour_labels(n: int, labels: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.zeros((n, len(LABELS)))
    if len(edges):
        np.add.at(out, (edges[:, 0], labels[edges[:, 1]]), 1)
        np.add.at(out, (edges[:, 1], labels[edges[:, 0]]), 1)
    return out


def fit_weights(sites: Sites, steps: int = 300, rate: float = 0.5, ridge: float = 0.2) -> SkipChain:
    """Pseudo-likelihood with a Gaussian prior, by gradient steps; no sites give the prior."""
    n, k = len(sites.spans), len(LABELS)
    prior = np.zeros((_FEATURES + 2 * k, k))
    prior[0, 0] = 2.0
    prior[_FEATURES + k :] = SKIP_PRIOR * np.eye(k)
    weights = prior.copy()
    if n:
        given = [sites.features, _neighbour_labels(n, sites.labels, sites.chain), _neighbour_labels(n, sites.labels, sites.skip)]
        inputs = np.concatenate(given, axis=1)
        # Many repeats of one number weigh as one neighbour each; their pull is cut off.
        inputs[:, _FEATURES:] = np.minimum(inputs[:, _FEATURES:], 2)
        # A number no pattern fits may still repeat one that a pattern does: no example of "none".
        sure = (sites.labels > 0) | (inputs[:, -k + 1 :].sum(axis=1) == 0)
        inputs, wanted, n = inputs[sure], np.eye(k)[sites.labels[sure]], int(sure.sum())
        for _ in range(steps):
            gradient = inputs.T @ (wanted - _softmax(inputs @ weights)) - ridge * (weights - prior)
            weights += rate * gradient / (n / 4 + ridge)
    chain, skip = weights[_FEATURES : _FEATURES + k], weights[_FEATURES + k :]
    # An edge has one potential for both directions.
    return SkipChain(weights[:_FEATURES], (chain + chain.T) / 2, (skip + skip.T) / 2)


def fit(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> SkipChain:
    """Fit on the ``sample_rows`` documents whose ids hash lowest; their sites alone reach the driver."""
    chosen = texts.select("doc_id").where("doc_id is not null").distinct()
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sites, and blanks for what lies between them, keep what the fit looks at.
        for batch in batches:
            kept = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                sites = find_sites([text or ""], [base])
                parts, end = [], 0
                for a, b in sorted(sites.spans):
                    if a >= end and b - a <= 200:
                        parts.append((" \n " if a - end <= NEAR else "\n" * (NEAR + 1)) + text[a:b])
                        end = b
                kept.append("".join(parts))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], names=["sites"])

    rows = texts.join(chosen, "doc_id", "left_semi").mapInArrow(short, "sites string").where("sites <> ''").collect()
    kept = sorted(r["sites"] for r in rows)
    return fit_weights(find_sites(kept, [base_spans(t) for t in kept]))


def personal_data(docs: DataFrame, model: SkipChain | None = None, min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """One row per document: ``doc_id, base, spans``, each ``array<struct<kind,start,end>>`` by start and kind.

    ``spans`` are the base spans and those that the field adds where no base
    span lies. Places are code points, ends exclusive. A null or empty text has
    no spans. Repeated rows give repeated rows, a null id stays null; only rows
    with an id are fitted on. Very long texts are read whole; a number-like site has
    at most 40 digits within 64 characters, and an address is compared by its first
    200. Other columns are not read, so their names cannot clash. No rows give no rows.
    """
    texts = read_texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(texts))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows_of(spans: list[tuple[int, int, str]]) -> list[dict]:
        return [{"kind": k, "start": a, "end": b} for a, b, k in spans]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.as_py() or "" for v in batch.column(1)]
            bases = [base_spans(t) for t in texts]
            sites = find_sites(texts, bases)
            added: list[list[tuple[int, int, str]]] = [[] for _ in texts]
            if len(sites.spans):
                chance = shared.value.marginals(sites)
                best = chance.argmax(axis=1)
                for i in np.flatnonzero((sites.labels == 0) & (best > 0) & (chance.max(axis=1) >= min_marginal)):
                    added[sites.owner[i]].append((*sites.spans[i], LABELS[best[i]]))
            every = [sorted(b + a, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) for b, a in zip(bases, added)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([rows_of(b) for b in bases], kind), pa.array([rows_of(s) for s in every], kind)],
                names=["doc_id", "base", "spans"],
            )

    spans = "array<struct<kind:string,start:long,end:long>>"
    return texts.mapInArrow(find, f"doc_id long, base {spans}, spans {spans}")
