"""Secret scans: fixed rules, and two character Markov models compared by log-likelihood ratio.

Both models are first-order chains over the 68 characters of keys and identifiers. The one of random
strings learns from values that the fixed rules found, the one of ordinary identifiers from all other
long words; the labels are those of the rules. A run of key characters that no rule covers becomes a
span of kind `random` if the ratio speaks for the random model, in total and per character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import Taken, batch, workers_import

Span = tuple[int, int, str]

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_NAMES = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Shorter runs of hex digits would be dropped anyway; a run is entered at its first digit only.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET)
#: State before the first character, and of any other character.
OUTSIDE = SIZE
STATES = SIZE + 1
_CODE = np.full(256, OUTSIDE, np.int64)
_CODE[list(ALPHABET.encode())] = np.arange(SIZE)

#: Shortest run that may be random, and what the log-likelihood ratio must reach, in nats.
CANDIDATE, TOTAL, PER_CHARACTER = 20, 10.0, 0.5
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE)
#: What trains the model of ordinary identifiers.
_ORDINARY = re.compile(r"[A-Za-z0-9_]{8,}")
#: Weight of the counts in each model; the rest is uniform, so that unseen steps stay possible.
COUNTED = {"random": 0.6, "ordinary": 0.98}


def base_matches(text: str) -> list[tuple[Span, str]]:
    """Spans of the fixed rules with the secret value in each, by start and kind."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [((*m.span(), "assign"), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [((*m.span(), "access"), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [((*m.span(), "hex"), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0][0], KINDS.index(f[0][2])))


def steps(word: str) -> np.ndarray:
    """Codes of the transitions of a word, its start included."""
    codes = _CODE[np.frombuffer(word.encode("ascii", "replace"), np.uint8)]
    return np.concatenate([[OUTSIDE], codes[:-1]]) * STATES + codes


def log_ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Log-likelihood ratio of each transition from its counts under both labels.

    Without a labelled secret the model of random strings is uniform; without an ordinary word the
    other one is, and nothing is random.
    """
    logs = {}
    for label, weight in COUNTED.items():
        table = counts[label].reshape(STATES, STATES)[:, :SIZE].astype(float)
        total = table.sum(axis=1, keepdims=True)
        seen = np.divide(table, total, out=np.full_like(table, 1 / SIZE), where=total > 0)
        logs[label] = np.log(weight * seen + (1 - weight) / SIZE)
    ratios = np.zeros((STATES, STATES))
    ratios[:, :SIZE] = logs["random"] - logs["ordinary"]
    return ratios.reshape(-1)


def added_spans(text: str, base: list[Span], ratios: np.ndarray) -> list[Span]:
    """Runs of key characters outside the base spans that the random model explains better."""
    out, taken = [], Taken((a, b) for a, b, _ in base)
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        if taken.meets(start, end):
            continue
        score = ratios[steps(m[0])].sum()
        if score >= TOTAL and score >= PER_CHARACTER * (end - start):
            out.append((start, end, "random"))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {label: np.zeros(STATES * STATES, np.int64) for label in COUNTED}
    for part in batches:
        for text in part.column(0).to_pylist():
            base = base_matches(text)
            for _, value in base:
                counts["random"] += np.bincount(steps(value), minlength=STATES * STATES)
            at, pieces = 0, []
            for (start, end, _), _ in base:
                if start >= at:
                    pieces.append(text[at:start])
                at = max(at, end)
            pieces.append(text[at:])
            # A dot between words returns to the state outside, as each word's start needs.
            words = "\n".join(w for piece in pieces for w in _ORDINARY.findall(piece))
            if words:
                codes = steps(words)
                codes = codes[codes % STATES != OUTSIDE]
                counts["ordinary"] += np.bincount(codes, minlength=STATES * STATES)
    for label, table in counts.items():
        seen = np.flatnonzero(table)
        yield batch(COUNTS, [label] * len(seen), seen, table[seen])


COUNTS = pa.schema([("label", pa.string()), ("step", pa.int64()), ("n", pa.int64())])


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log ratios of all transitions, from every text of `docs`.

    Tasks count on their own; at most 2 x 69 x 69 sums come to the driver, whatever the corpus.
    """
    workers_import(docs.sparkSession)
    counts = {label: np.zeros(STATES * STATES, np.int64) for label in COUNTED}
    counted = docs.select(text).where(F.col(text).isNotNull()).mapInArrow(_counted, "label string, step long, n long")
    for label, step, n in counted.groupBy("label", "step").agg(F.sum("n")).collect():
        counts[label][step] = n
    return log_ratios(counts)


RESULT = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def digest_of(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, ratios: np.ndarray, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by kind, digest of the base spans and all spans, for every row of `docs`.

    Null texts count as empty, null ids stay null, repeated rows give repeated rows, an empty table
    gives none; other columns are not read. `ratios` comes from `train` (38 kB).
    """
    workers_import(docs.sparkSession)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for doc_id, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                value = value or ""
                base = [span for span, _ in base_matches(value)]
                spans = base + added_spans(value, base, ratios)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                kinds = [kind for _, _, kind in spans]
                digest = hashlib.sha256(digest_of(base).encode()).hexdigest()
                rows.append((doc_id, *map(kinds.count, KINDS), digest, digest_of(spans)))
            yield batch(RESULT, *(zip(*rows, strict=True) if rows else [[]] * len(RESULT)))

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col(id_column).cast("long"), text).mapInArrow(
        scanned, f"doc_id long, {kinds}, base_sha256 string, spans string"
    )
