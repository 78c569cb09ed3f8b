"""Quality rules: a decision list learned from labelled statistics of documents.

Sequential covering, as in RIPPER: a rule for low quality is a conjunction of thresholds, grown on two
thirds of the samples by information gain and pruned on the rest; what it covers is taken away, and
the next one is grown. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, stored, workers_import

#: Fixed value: what counts as a symbol.
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"!?.,;:"
_DIGITS = b"0123456789"

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_marks",
    "n_digits",
    "longest_word",
)
#: Learned from about this many labelled documents at most, picked by a hash of id, label and statistics.
FIT_ROWS = 20_000


def _repeat_words(words: list[bytes]) -> int:
    """Words within a window of three that the text has twice or more, the first one included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1].reshape(-1)
    windows, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)[1:]
    again = counts[windows.reshape(-1)] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The statistics COUNTS of a text; words are split at ASCII white space."""
    raw = text.encode("utf-8", "replace") if text else b""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]

    def of(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    return (
        len(words),
        (len(text) if text else 0) - of(_SPACES),
        of(SYMBOLS),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        of(_UPPER),
        of(_MARKS),
        of(_DIGITS),
        max(map(len, words), default=0),
    )


RESULT = pa.schema([(c, pa.int64()) for c in ("doc_id", *COUNTS)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        rows = [counts_of(text) for text in part.column(1).to_pylist()]
        yield batch(RESULT, part.column(0), *(zip(*rows, strict=True) if rows else [[]] * len(COUNTS)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row of `docs`, from the whole text; null counts as empty."""
    workers_import(docs.sparkSession)
    schema = ", ".join(f"{c} long" for c in ("doc_id", *COUNTS))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counted, schema)


#: Ratios that rules look at: numerator and denominator, the latter never below one. None of them
#: drifts with the length of a text, as the share of distinct words would.
RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}
FEATURES = ("n_words", "longest_word", *RATIOS)


def features() -> dict[str, Column]:
    out = {name: F.col(name).cast("double") for name in ("n_words", "longest_word")}
    return out | {name: F.col(a) / F.greatest(F.col(b), F.lit(1)) for name, (a, b) in RATIOS.items()}


@dataclass(frozen=True)
class Test:
    """One threshold on one feature."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, table: pd.DataFrame) -> np.ndarray:
        value = table[self.feature].to_numpy()
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, table: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(table), bool)
    for test in rule:
        out &= test.holds(table)
    return out


def _candidates(table: pd.DataFrame, steps: int = 48) -> list[Test]:
    out = []
    for name in FEATURES:
        values = np.unique(table[name].to_numpy())
        if len(values) > 1:
            middles = (values[1:] + values[:-1]) / 2
            evenly = np.linspace(0, len(middles) - 1, min(steps, len(middles))).astype(int)
            ranks = np.linspace(0, len(table) - 1, steps).astype(int)
            by_rank = np.searchsorted(values, np.sort(table[name].to_numpy())[ranks])
            # A cut lies halfway between two values, so that it keeps its distance from both sides.
            cuts = middles[np.unique(np.minimum([*evenly, *by_rank], len(middles) - 1))]
            out += [Test(name, above, float(cut)) for cut in cuts for above in (True, False)]
    return out


def _grow(table: pd.DataFrame, bad: np.ndarray, tests: list[Test], longest: int = 4) -> Rule:
    rule: Rule = ()
    held = [test.holds(table) for test in tests]
    covered = np.ones(len(table), bool)
    while len(rule) < longest and (covered & ~bad).any():
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        gains = []
        for mask in held:
            now = covered & mask
            q, m = (now & bad).sum(), (now & ~bad).sum()
            gains.append(q * (np.log2(q / (q + m)) - np.log2(p / (p + n))) if q else -np.inf)
        best = int(np.argmax(gains))
        if gains[best] <= 0:
            break
        rule += (tests[best],)
        covered &= held[best]
    return rule


def _worth(rule: Rule, table: pd.DataFrame, bad: np.ndarray) -> float:
    covered = _covers(rule, table)
    p, n = (covered & bad).sum(), (covered & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def _tightest(rule: Rule) -> Rule:
    """Of several thresholds on one side of a feature, the one that implies the others."""
    kept: dict[tuple[str, bool], Test] = {}
    for test in rule:
        side = (test.feature, test.above)
        tighter = max if test.above else min
        kept[side] = tighter(kept.get(side, test), test, key=lambda t: t.threshold)
    return tuple(kept.values())


def learn_rules(table: pd.DataFrame, bad: np.ndarray, most: int = 16, least_precision: float = 0.9) -> list[Rule]:
    """Rules for the bad rows of `table` (FEATURES), in the order in which they were learned.

    Learning stops when a pruned rule is right on less than `least_precision` of what it covers, or
    covers fewer than three bad rows. No bad rows give no rules.
    """
    rules: list[Rule] = []
    left = np.ones(len(table), bool)
    fold = np.arange(len(table)) % 3
    while len(rules) < most and (bad & left).sum() >= 3:
        grown, pruned = left & (fold != 2), left & (fold == 2)
        part = table[grown]
        if not bad[grown].any():
            break
        rule = _grow(part, bad[grown], _candidates(part))
        while len(rule) > 1 and _worth(rule[:-1], table[pruned], bad[pruned]) >= _worth(rule, table[pruned], bad[pruned]):
            rule = rule[:-1]
        rule = _tightest(rule)
        covered = _covers(rule, table) & left
        right, wrong = (covered & bad).sum(), (covered & ~bad).sum()
        if not rule or right < 3 or right < least_precision * (right + wrong):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    chain = None
    for rule in rules:
        test = rule[0].column()
        for more in rule[1:]:
            test = test & more.column()
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return chain.otherwise(F.lit(True))


def described(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold:g}" for t in rule) for rule in rules]


def train(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from statistics joined with labels (doc_id, quality: 0 is bad).

    The join carries numbers only, and rows that are alike in id, label and statistics count once. Beyond
    `fit_rows` of these a hash of all three picks about that many. Null ids and labels are not used.
    """
    known = labels.select(F.col("doc_id").alias("id"), "quality").where("quality is not null").distinct()
    once = stats.select("doc_id", *COUNTS).distinct()
    joined = stored(once.join(known, once["doc_id"] == known["id"]).select("id", "quality", *COUNTS), "quality-labelled")
    hashed = F.pmod(F.xxhash64("id", "quality", *COUNTS, F.lit("fit")), F.lit(1 << 53))
    share = hashed < (1 << 53) * min(1.0, fit_rows / max(1, joined.count()))
    rows = (
        joined.where(share)
        .select("id", "quality", *[c.alias(n) for n, c in features().items()])
        .orderBy("id", "quality", *FEATURES)
        .toPandas()
    )
    return learn_rules(rows[list(FEATURES)].astype(float), rows["quality"].to_numpy() == 0)


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed and kept for every row of `docs`.

    The statistics are written once and read for learning and for the verdict. A null text has no
    words and fails the base rules; null ids stay null; repeated rows give repeated rows; without
    labels only the base rules decide; an empty table gives no rows.
    """
    stats = stored(statistics(docs), "quality-statistics")
    rules = train(stats, labels)
    failed = F.expr(BASE_FAILED)
    return stats.select(
        "doc_id",
        *COUNTS[:5],
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(verdict(rules)).alias("kept"),
    )
