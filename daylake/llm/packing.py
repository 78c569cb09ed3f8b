"""Packing by concatenate and cut: token streams of all documents, cut into windows of fixed length.

The first pass tokenizes each partition once, stores the ids and notes where each document starts
within its partition. A prefix sum over the partitions' totals, one number per task, gives every
document its place in the whole stream; the second pass cuts the stored ids at multiples of the
window. A document that crosses a cut leaves one record on each side. Only the last window is short.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, stored, texts_as_bytes, workers_import

WINDOW, END = 4_096, 2
#: Words whose ids a worker remembers before it starts over.
REMEMBERED = 800_000


#: Marks that end a word after an ASCII or Latin-1 letter or a digit. Pre-tokenizers that keep marks
#: apart from letters and digits cut there anyway. A search goes by the first mark, then looks back.
_MARKS = re.compile(
    rb"[.,!?;:*#$%&|<>)](?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,!?;:*#$%&|<>)]*(?=[ \t\n\v\f\r]|\Z)"
)


#: Case, white space, marks at the ends of words and within them: what tells whether words may be
#: encoded one by one.
_PROBE = b"The End, the END.\tOf it's\n\n a-b (c) x!? 3.5; 1,000 $9 #tag \xc3\x89t\xc3\xa9: na\xc3\xafve* 50%  <a>|&  z."


#: Words of lower-case ASCII and Latin-1 letters, of which not all are ASCII.
_LETTERS = re.compile(rb"[a-z]*(?:\xc3[\x9f-\xb6\xb8-\xbf][a-z]*)+")


#: Such words, with every letter alone and beside others: what tells whether the model takes them as they are.
_PROBE_LETTERS = [
    form.encode()
    for letter in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
    for form in (letter, 2 * letter, f"th{letter}", f"{letter}ing", f"na{letter}ve{letter}")
]


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes other than the space that are no visible Latin-1 characters."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + n) for n, b in enumerate(hidden) if b != 32}


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, by way of remembered words where that holds.

    It holds for tokenizers of lower-case text that never join text across ASCII white space, nor
    letters and marks: a text's ids are then those of its words one after the other. A-Z are lowered
    and marks at the ends of words set apart beforehand, so that there are fewer words to remember.
    Words of letters alone go to the tokenizer's model straight away, where a second probe shows that its
    other steps leave them as they are.
    A tokenizer for which a probe text shows otherwise gets every text as a whole, and so does a text that
    may hold one of the tokenizer's added tokens, which are found before anything else.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Searched in lower case, so that a token that is matched after lowering is found as well.
        self.added = re.compile("|".join(map(re.escape, added)).encode()) if added else None
        self.known: dict[bytes, bytes] = {}
        self.by_model = self._of_letters(_PROBE_LETTERS) == self._of_any(_PROBE_LETTERS)
        self.by_words = self._by_words([_PROBE.lower()]) == self._whole([_PROBE])

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words:
            return self._whole(texts)
        lower = [text.lower() for text in texts]
        whole = [at for at, text in enumerate(lower) if self.added and self.added.search(text)]
        if not whole:
            return self._by_words(lower)
        held = set(whole)
        plain = iter(self._by_words([text for at, text in enumerate(lower) if at not in held]))
        encoded = iter(self._whole([texts[at] for at in whole]))
        return [next(encoded if at in held else plain) for at in range(len(texts))]

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        as_text = [text.decode("utf-8", "replace") for text in texts]
        encoded = self.tokenizer.encode_batch_fast(as_text, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in encoded]

    def _by_words(self, texts: list[bytes]) -> list[bytes]:
        """Of texts with A-Z lowered."""
        split = [_MARKS.sub(rb" \g<0>", text).split() for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*split).difference(self.known)
        if self.by_model:
            letters = [word for word in new if word.isalpha() or _LETTERS.fullmatch(word)]
            self.known.update(zip(letters, self._of_letters(letters), strict=True))
            new.difference_update(letters)
        if new:
            others = list(new)
            self.known.update(zip(others, self._of_any(others), strict=True))
        of = self.known.__getitem__
        return [b"".join(map(of, words)) for words in split]

    def _of_letters(self, words: list[bytes]) -> list[bytes]:
        """Straight from the model, for words that the steps before it leave whole."""
        tokenize = self.tokenizer.model.tokenize
        written = b" ".join(words).decode("latin-1").translate(_BYTE_LETTERS).split()
        return [array("I", [token.id for token in tokenize(word)]).tobytes() for word in written]

    def _of_any(self, words: list[bytes]) -> list[bytes]:
        """One call for all words; each id comes with the number of its word."""
        as_text = [word.decode("utf-8", "replace") for word in words]
        encoded = self.tokenizer.encode(as_text, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4").tobytes()
        sizes = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(words))
        ends = (4 * np.cumsum(sizes)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
)
PIECES = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)


def tokenized(docs: DataFrame, path: str, end: int = END, texts_at_once: int = 64) -> DataFrame:
    """(doc_id, part, start, n, ids): ids with the end id, and where they start in their partition."""
    workers_import(docs.sparkSession)
    last = np.array([end], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = encoder(path), TaskContext.get().partitionId(), 0
        for rows in batches:
            for at in range(0, rows.num_rows, texts_at_once):
                some = rows.slice(at, texts_at_once)
                ids = [x + last for x in encode(texts_as_bytes(some.column(1)))]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = start + np.cumsum(sizes)
                yield batch(TOKENS, some.column(0), [part] * len(ids), ends - sizes, sizes, ids)
                start = int(ends[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encoded, "doc_id long, part long, start long, n long, ids binary"
    )


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[tuple] = []
            for doc_id, place, total, ids in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                at = 0
                while at < total:
                    sequence, offset = divmod(place + at, window)
                    length = min(window - offset, total - at)
                    piece = ids[4 * at : 4 * (at + length)]
                    out.append((doc_id, at, length, zlib.crc32(piece), total, sequence, offset, piece))
                    at += length
            yield batch(PIECES, *(zip(*out, strict=True) if out else [[]] * len(PIECES)))

    return cut


def packed(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of documents in sequences of `window` tokens, with their ids as bytes.

    One row per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens
    (end id included), sequence_id and offset. `path` names a tokenizer file that the workers reach.
    A null or empty text is its end id alone, a null id stays null, a repeated row is a document of
    its own, an empty table gives no rows; other columns are not read. The order of the stream is that
    of the partitions and their rows; it is fixed when the ids are written. What comes to the driver
    is one total per task.
    """
    if window < 1:
        raise ValueError("a window holds one token at least")
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, path, end), "packing-tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([row["n"] for row in totals], dtype=np.int64)]).tolist()
    offsets = spark.createDataFrame(
        [(row["part"], first) for row, first in zip(totals, before)], "part long, first long"
    )
    placed = tokens.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("first") + F.col("start")).alias("place"), "n", "ids"
    )
    columns = ", ".join(f"{name} long" for name in PIECES.names[:-1])
    return placed.mapInArrow(_cut(window), f"{columns}, ids binary")


def sequences(pieces: DataFrame, window: int = WINDOW, padding: int = END) -> DataFrame:
    """(sequence_id, length, ids): pieces put together, padded to the window.

    A sequence whose length is a power of two stays as it is. One group is one window, whose size
    bounds it.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), ordered.alias("parts"))
    joined = F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, b: F.concat(a, b))
    short = (F.lit(window) - F.col("length")) * (F.expr("bit_count(length)") != 1).cast("int")
    pad = F.unhex(F.lit(np.array([padding], "<u4").tobytes().hex()))
    return whole.select(
        "sequence_id", "length", F.concat(joined, F.unhex(F.repeat(F.hex(pad), short.cast("int")))).alias("ids")
    )
