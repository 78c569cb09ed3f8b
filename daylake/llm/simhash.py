"""SimHash near-duplicates: fingerprints whose segments are decoded to nearby Golay codewords.

64 bits are four segments of 16. Two fingerprints that differ in at most three bits agree in one
segment at least; of the other 48 bits, cut into two halves, one half differs in at most one bit.
So for each segment and each half, a key is the segment's bits and the index of a codeword near the
half's first 23 bits: words at most one bit apart always share such an index. Fingerprints that
share a key are compared, and those within the limit are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.llm.common import batch, stored, workers_import
from daylake.llm.components import connected_components
from daylake.llm.golay import nearby_indices

SEED = 42
KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash over the XXH64 of word shingles, as an unsigned number; no word gives 0.

    Words are split at ASCII white space and A-Z lower-cased. Repeated shingles count repeatedly; a
    text of fewer than `width` words is one shingle.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - width + 1)].tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts))
    return _majority(hashes)


def _majority(hashes: np.ndarray, rows: int = 32_768) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), rows):
        part = hashes[at : at + rows].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    values = [fingerprint(t.encode() if t else b"") for t in texts]
    return pd.Series(np.array(values, np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", into: str = "fp") -> DataFrame:
    """`docs` with the signed 64-bit fingerprint of `text`; null is an empty text."""
    workers_import(docs.sparkSession)
    return docs.withColumn(into, _fingerprints(F.col(text)))


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) pairs of unsigned fingerprints: 8 families of one to six keys each."""
    keys, rows = [], []
    for segment in range(4):
        low = fps & np.uint64((1 << 16 * segment) - 1)
        exact = (fps >> np.uint64(16 * segment) & np.uint64(0xFFFF)).astype(np.int64)
        high = fps >> np.uint64(16 * segment + 16) if segment < 3 else np.zeros_like(fps)
        rest = low | high << np.uint64(16 * segment)
        for half in range(2):
            word = (rest >> np.uint64(24 * half) & np.uint64(0x7FFFFF)).astype(np.int64)
            near = nearby_indices(word)
            row, column = np.nonzero(near >= 0)
            keys.append((segment * 2 + half) << 28 | exact[row] << 12 | near[row, column])
            rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        fps = part.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4_096):
            some = fps[at : at + 4_096]
            keys, rows = golay_keys(some.view(np.uint64))
            yield batch(KEYS, keys, some[rows])


def _links_of(group: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """A spanning forest of the links in one bucket: what is reached leaves the open set at once, so
    a dense bucket costs about its size and yields at most one link per member."""
    found, open_ = [], group
    while len(open_) > 1:
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            near = np.bitwise_count(open_ ^ at) <= limit
            if near.any():
                reached = open_[near]
                found += [(at, x) for x in reached]
                frontier += list(reached)
                open_ = open_[~near]
    return found


def links_in_sorted(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from (key, fp) rows sorted by key. Rows of one key may span batches."""
    rest_k, rest_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def closed(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= limit]
        a, b = [fps[two]], [fps[two + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            if found := _links_of(fps[start : start + size], limit):
                pairs = np.array(found, np.uint64)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
        return batch(EDGES, pairs[:, 0].copy().view(np.int64), pairs[:, 1].copy().view(np.int64))

    for part in batches:
        keys = part.column(0).to_numpy(zero_copy_only=False)
        fps = part.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        held.append((keys, fps))
        if keys[0] == keys[-1] and all(k[0] == keys[0] for k, _ in held):
            continue  # one key only so far
        all_k, all_f = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = int(np.searchsorted(all_k, all_k[-1]))
        yield closed(all_k[:cut], all_f[:cut])
        held = [(all_k[cut:], all_f[cut:])]
    if held:
        rest_k, rest_f = (np.concatenate(x) for x in zip(*held, strict=True))
        yield closed(rest_k, rest_f)


def fingerprint_links(fps: DataFrame, limit: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that connect all within `limit` bits.

    `limit` is at most 3, which is what the keys are built for. Exact copies share a fingerprint and
    are one row here. A key's rows are streamed from a sorted shuffle: the bucket of a key holds
    8 bytes for each distinct fingerprint in it and yields fewer links than members, never all pairs.
    """
    if not 0 <= limit <= 3:
        raise ValueError("the keys cover at most three differing bits")
    workers_import(fps.sparkSession)
    keyed = fps.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    ordered = keyed.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(lambda rows: links_in_sorted(rows, limit), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs`: the component's least id, over all links.

    Null texts count as empty. A null id gets a component and never names one, unless the component
    has no other: then component_id is null too. Rows that repeat an id are kept, each with its own
    text's fingerprint. An empty table gives no rows. Other columns are not read.
    """
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(slim).select("doc_id", "fp"), "simhash-prints")
    return prints.join(_components(prints, limit), "fp").select("doc_id", "fp", "component_id")


def _components(prints: DataFrame, limit: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in `prints` (doc_id, fp); the root tells components
    apart that have the same least id because an id repeats."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    return rooted(nodes, connected_components(fingerprint_links(nodes, limit), "simhash-links"))


def rooted(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(fp, root, component_id) of `nodes` (fp, least_id), from the labels of those that have links."""
    known = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("label", "fp").alias("root")
    )
    least = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return known.join(least, "root").select("fp", "root", "component_id")


def one_per_group(docs: DataFrame, limit: int = 3) -> DataFrame:
    """`docs` with one document of each near-duplicate group, the one with the least doc_id.

    All columns stay. Of rows that repeat an id and a fingerprint one stays, and so in a group whose
    ids are all null. Texts of one id that are no near-duplicates are groups of their own. The fingerprinted documents are written once, so that the Python work on the
    texts is not done again for the second pass.
    """
    mark = "__simhash_fp"
    marked = stored(with_fingerprint(docs, into=mark), "simhash-documents")
    prints = marked.select("doc_id", F.col(mark).alias("fp"))
    return least_rows(marked, _components(prints, limit), mark).select(docs.columns)


def least_rows(marked: DataFrame, components: DataFrame, mark: str) -> DataFrame:
    """Of each component (fp, root, component_id) the rows of `marked` with its least doc_id, repeated ones once."""
    kept = "__kept"
    prints = marked.select("doc_id", F.col(mark).alias("fp"))
    chosen = (
        prints.join(components, "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id")
        .agg(F.min("fp").alias("fp"))
    )
    keys = chosen.select(F.struct("doc_id", "fp").alias(kept))
    joined = marked.join(
        keys, marked["doc_id"].eqNullSafe(keys[f"{kept}.doc_id"]) & (marked[mark] == keys[f"{kept}.fp"])
    )
    return joined.dropDuplicates(["doc_id", mark]).drop(kept)
