"""Language identification by a string kernel.

A text is the set of its letter n-grams (presence, several lengths blended), hashed to SLOTS. The
kernel of two texts is the number of shared n-grams over the root of both set sizes. Nyström landmark
texts span the feature space; kernel ridge regression is solved in it, one language against the rest.
Texts are scored in batches: presence matrix x landmark matrix gives the kernel values, and those x
the folded coefficients give one score for each language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.llm.common import batch, workers_import

LENGTHS = (2, 3, 4)
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
#: Fit on at most this many labelled documents of a language, none longer than this if it has shorter
#: ones, whatever the size of the table. All are read whole.
PER_LANGUAGE, FIT_CHARS = 400, 8_000
LANDMARKS, RIDGE = 128, 0.05
#: Below this kernel value to every landmark, a score falls in proportion.
FAMILIAR = 0.02
#: Texts in one matrix product.
BATCH = 64
UNDETERMINED = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, set(text)))


def grams(text: str, scratch: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashed n-grams of a text; what is no letter becomes one space."""
    scratch = np.empty(SLOTS, np.int64) if scratch is None else scratch
    letters = f" {_NO_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32)
    found = []
    for length in LENGTHS:
        if len(codes) < length:
            continue
        mixed = np.full(len(codes) - length + 1, length, np.uint32)
        for at in range(length):
            mixed = mixed * np.uint32(0x01000193) + codes[at : at + len(mixed)]
        found.append((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS))
    slots = np.concatenate(found).astype(np.int64)
    # The last writer of a slot in the scratch table stands for all its n-grams.
    places = np.arange(len(slots))
    scratch[slots] = places
    return slots[scratch[slots] == places]


@dataclass
class Model:
    """Landmark n-grams (at most SLOTS x LANDMARKS bytes) and folded coefficients."""

    languages: list[str]
    rows: np.ndarray
    landmarks: np.ndarray
    coefficients: np.ndarray
    scratch: np.ndarray | None = field(default=None, repr=False)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text one score per language, about 1 for its own and -1 for the others, and the
        largest kernel value, which is near 0 for a text unlike any landmark."""
        if self.scratch is None:
            self.scratch = np.empty(SLOTS, np.int64)
        present = np.zeros((len(texts), self.landmarks.shape[0]), np.float32)
        sizes = np.ones(len(texts), np.float32)
        for at, text in enumerate(texts):
            slots = grams(text, self.scratch)
            known = self.rows[slots]
            present[at, known[known >= 0]] = 1
            sizes[at] = max(1, len(slots))
        kernel = present @ self.landmarks / np.sqrt(sizes)[:, None]
        return kernel @ self.coefficients, kernel.max(axis=1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score from 0 to 1); undetermined and 0 for texts without a letter."""
        out = [(UNDETERMINED, 0.0)] * len(texts)
        asked = [at for at, text in enumerate(texts) if self.languages and has_letter(text)]
        for start in range(0, len(asked), BATCH):
            some = asked[start : start + BATCH]
            values, nearest = self.scores([texts[at] for at in some])
            familiar = np.clip(nearest / FAMILIAR, 0, 1)
            for at, row, share in zip(some, values, familiar, strict=True):
                best = int(row.argmax())
                out[at] = (self.languages[best], float(np.clip((row[best] + 1) / 2, 0, 1) * share))
        return out


def fit_model(samples: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on (text, language) samples; no samples give a model that knows none."""
    languages = sorted({language for _, language in samples})
    sets = [grams(text) for text, _ in samples]
    # Landmarks are spread over the samples, which come by language.
    chosen = np.unique(np.linspace(0, len(samples) - 1, min(landmarks, len(samples))).astype(int)) if samples else []
    slots = np.unique(np.concatenate([sets[i] for i in chosen])) if len(chosen) else np.zeros(0, np.int64)
    rows = np.full(SLOTS, -1, np.int32)
    rows[slots] = np.arange(len(slots))
    matrix = np.zeros((len(slots), len(chosen)), np.float32)
    for column, i in enumerate(chosen):
        matrix[rows[sets[i]], column] = 1 / np.sqrt(len(sets[i]))
    if not samples:
        return Model([], rows, matrix, np.zeros((0, 0), np.float32))
    kernel = np.zeros((len(samples), len(chosen)))
    for at, found in enumerate(sets):
        known = rows[found]
        kernel[at] = matrix[known[known >= 0]].sum(axis=0) / np.sqrt(len(found))
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > 1e-6
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ whiten
    known = np.array([languages.index(language) for _, language in samples])
    targets = np.where(known[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Languages weigh the same, however many of their samples there are.
    weights = 1 / np.bincount(known)[known]
    weights *= len(samples) / weights.sum()
    weighted = features * weights[:, None]
    solved = np.linalg.solve(weighted.T @ features + ridge * np.eye(features.shape[1]), weighted.T @ targets)
    return Model(languages, rows, matrix, (whiten @ solved).astype(np.float32))


def remainder(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 3


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, chars: int = FIT_CHARS) -> list[tuple[str, str]]:
    """At most `per_language` labelled (text, language) of each language outside the held-out third.

    Distinct texts are counted for each language by sketches; a hash of the text then picks a few times as
    many of them as needed, so that what is ranked and sent does not grow with the table. A null id, text
    or language and a text without a letter are not used. Texts longer than `chars` are used only where a
    language has no shorter one, the shortest first, until they have per_language * chars characters; each
    is read whole. Equal texts count once.
    """
    labelled = docs.select("doc_id", "text", "lang").where((remainder() != 1) & F.col("lang").isNotNull())
    size = F.char_length("text")
    hashed = labelled.where(F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text", F.lit("sample")).alias("h"), size.alias("size"), (size > chars).alias("long")
    )
    distinct: dict[str, tuple[bool, int]] = {}
    for lang, long, n in hashed.groupBy("lang", "long").agg(F.approx_count_distinct("h")).collect():
        distinct[lang] = min(distinct.get(lang, (True, n)), (long, n))
    if not distinct:
        return []
    share = F.create_map(
        *[F.lit(x) for lang, (_, n) in distinct.items() for x in (lang, min(1.0, 5 * per_language / max(1, n)))]
    )
    from_long = F.create_map(*[F.lit(x) for lang, (long, _) in distinct.items() for x in (lang, long)])
    steps = 1 << 53
    near = hashed.where(
        (F.col("long") == F.element_at(from_long, F.col("lang")))
        & (F.pmod("h", F.lit(steps)) < F.element_at(share, F.col("lang")) * steps)
    )
    # Copies become one row before the shuffle, so that none is ranked however many there are.
    single = near.groupBy("lang", "h", "size", "long").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.when(F.col("long"), F.col("size")), "h")
    best = (
        single.withColumn("rank", F.row_number().over(order))
        .withColumn("before", F.sum("size").over(order) - F.col("size"))
        .where((F.col("rank") <= per_language) & (~F.col("long") | (F.col("before") < per_language * chars)))
    )
    rows = best.orderBy("lang", "rank").collect()
    return [(row["text"], row["lang"]) for row in rows if has_letter(row["text"])]


RESULT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of `docs`, from its whole text only.

    A null text and one without a letter are `und` with score 0. A null id stays null and is not held
    out. Repeated rows give repeated rows, an empty table none; other columns are not read.
    """
    workers_import(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            predicted = model.predict(part.column(1).to_pylist())
            yield batch(RESULT, part.column(0), [p[0] for p in predicted], [p[1] for p in predicted])

    return (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(scored, "doc_id long, lang_pred string, score double")
        .select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
    )


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of `docs` whose language is found with a score of at least `least`; all columns stay.

    A null text and one without a letter go, whatever their id; repeated rows are each kept or not, an empty
    table gives none. A model that was given no labelled text knows no language to reject a text by: every text
    with a letter then stays.
    """
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    workers_import(docs.sparkSession)

    def scored(texts: pd.Series) -> pd.Series:
        predicted = model.predict([t if isinstance(t, str) else None for t in texts])
        return pd.Series([lang != UNDETERMINED and score >= least for lang, score in predicted], dtype=bool)

    scored.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.where(F.pandas_udf(scored, T.BooleanType())(F.col("text")))
