"""Language-model scoring with a hierarchical Pitman-Yor model.

Words sit in one restaurant whose base is a spelling model: restaurants of byte contexts that share
parents. The context of a byte is the byte before it, then the classes (low five bits) of the second
and the third before; each longer context's tables are customers of the shorter one, and those of the
shortest sit in the root, over uniform bytes. A table of the word restaurant is one spelling of its
word, a customer of each of its byte contexts.

Below the word restaurant the corpus has one for each preceding word; the end of a text precedes the next. A
table of such a restaurant is a customer of the word restaurant.

A text adds two levels below these while it is read: one of its own, and below that one
for each preceding word in it. They know the text's past only, so that the score stays a probability.

Seatings of the corpus are sampled by blocked Gibbs steps: the spelling restaurants given the tables of words, then
the tables of words given the spellings, and again; then the tables of all pairs of words given the word
restaurant, and once more the words and the spellings given these. It starts with a table for each customer
of a pair. Predictive probabilities of words and spellings are averaged over draws; those of pairs are of the one seating that
the word restaurant has its customers from, so that what may follow a word has chances that sum to one.
Tasks draw from generators seeded by what they read, so that a task run again draws the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import as_list, batch, packed_numbers, stored, stored_by, unpacked_numbers, workers_import
from daylake.llm.pitmanyor import Keyed, draw_tables, draws_of_tables, mixed

#: The end of a text, as a word: no word is empty.
END = b""
#: Byte that ends a word; it is white space and so never within one.
STOP = 10
CLASS_BITS = 5
CONTEXTS = 1 << (8 + 2 * CLASS_BITS)
#: Discount and strength of the spelling restaurants, from the root to the longest context.
DISCOUNTS, STRENGTHS = (0.2, 0.4, 0.6, 0.7), (1.0, 1.0, 1.0, 1.0)
#: Sweeps before the draws that count, and draws.
BURN_IN, DRAWS = 4, 6
#: Rounds of spellings given words and words given spellings.
ROUNDS = 2
#: Discount and strength of a text's own restaurant and of those of its preceding words.
TEXT_DISCOUNTS, TEXT_STRENGTHS = (0.9, 0.9), (100.0, 1.0)
#: Words of texts that are scored at once.
WORDS_AT_ONCE = 100_000
#: Distinct words that a task holds before it starts a new block.
BLOCK_WORDS = 1_000_000
#: Tokens after which a block is closed as well: its pairs are held at up to 60 bytes each.
BLOCK_TOKENS = 4_000_000
#: Bytes of texts that are numbered at once.
BYTES_AT_ONCE = 2_000_000
#: Strength of the corpus's restaurants of preceding words.
PAIR_STRENGTH = 1.0
#: Tokens of the corpus for each task that sums up pairs, and rows of dictionaries for each that sums up words.
SHARD_TOKENS, PART_ROWS = 2_000_000, 300_000


def in_training(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 7 != 2, F.lit(False))


CODED = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("train", pa.bool_()),
        ("ids", pa.binary()),
        ("local", pa.int64()),
        ("word", pa.binary()),
        ("n_train", pa.int64()),
        ("key", pa.binary()),
    ]
)
CODED_SCHEMA = "block long, doc_id long, train boolean, ids binary, local long, word binary, n_train long, key binary"


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as numbers of words, and then the hashes of the block's words, and its words with their training
    counts: what is read together lies together."""
    block = TaskContext.get().partitionId() << 20
    held, tokens, listed = [], 0, 0
    for rows in batches:
        lengths = pa.compute.binary_length(rows.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        for low, high in _in_parts(lengths, BYTES_AT_ONCE):
            some = rows.slice(low, high - low)
            sizes, coded = _coded(some.column(1))
            held.append((some.column(0), some.column(2), sizes, coded.indices.to_numpy(), coded.dictionary))
            tokens += len(coded)
            listed += len(coded.dictionary)
            if listed > BLOCK_WORDS:
                listed = len(pa.concat_arrays([x[-1] for x in held]).unique())
            if listed > BLOCK_WORDS or tokens > BLOCK_TOKENS:
                yield from _coded_block(block, held)
                block += 1
                held, tokens, listed = [], 0, 0
    if held:
        yield from _coded_block(block, held)


def _coded(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many words each text has, its end included, and the words of all."""
    trimmed = pa.compute.ascii_trim_whitespace(pa.compute.ascii_lower(texts.fill_null("")))
    # White space after the last word leaves an empty string, and so does an empty text.
    closed = pa.compute.if_else(
        pa.compute.equal(trimmed, ""), trimmed, pa.compute.binary_join_element_wise(trimmed, "", " ")
    )
    split = pa.compute.ascii_split_whitespace(closed)
    return pa.compute.list_value_length(split).to_numpy().astype(np.int64), split.flatten().dictionary_encode()


def _coded_block(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    listed = pa.concat_arrays([x[-1] for x in held]).dictionary_encode()
    numbers, words = listed.indices.to_numpy().astype("<u4"), listed.dictionary.cast(pa.binary())
    counts, at = np.zeros(len(words), np.int64), 0
    for doc_id, train, sizes, indices, some in held:
        ids = numbers[at : at + len(some)][indices]
        at += len(some)
        counts += np.bincount(ids[np.repeat(train.to_numpy(zero_copy_only=False), sizes)], minlength=len(words))
        data, ends, size = ids.tobytes(), (4 * np.cumsum(sizes)).tolist(), len(sizes)
        texts, nothing = [data[a:b] for a, b in zip([0, *ends], ends)], [None] * size
        yield batch(CODED, [block] * size, doc_id, train, texts, *[nothing] * 4)
    for at in range(0, len(words), 20_000):
        keys = [xxhash.xxh64_intdigest(word, 42) for word in as_list(words[at : at + 20_000])]
        yield batch(CODED, [block], *[[None]] * 3, [at], *[[None]] * 2, [np.array(keys, "<u8").tobytes()])
    for at in range(0, len(words), 20_000):
        some = words[at : at + 20_000]
        size = len(some)
        of, nothing = np.full(size, block), [None] * size
        local, n = np.arange(at, at + size), counts[at : at + size]
        yield batch(CODED, of, *[nothing] * 3, local, some, n, nothing)


def contexts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (context << 8 | byte) of all bytes of the words, stops included, and where words start."""
    joined = np.frombuffer(b"\n".join(words) + b"\n", np.uint8).astype(np.int64)
    starts = np.concatenate([[0], np.flatnonzero(joined == STOP)[:-1] + 1])
    low = (1 << CLASS_BITS) - 1
    before = np.concatenate([[0], joined[:-1]])
    before[before == STOP] = 0
    second = np.concatenate([[0], before[:-1]]) * (before > 0)
    third = np.concatenate([[0], second[:-1]]) * (second > 0)
    context = (before << 2 * CLASS_BITS) | ((second & low) << CLASS_BITS) | (third & low)
    return context << 8 | joined, starts


@dataclass
class Spelling:
    """log10 of the averaged predictive probabilities: one row of 256 per restaurant that has been
    seen (at most CONTEXTS x 33/32 + 257 rows of 1 KiB), and the row of each context, that of its longest
    seen suffix."""

    rows: np.ndarray
    row_of: np.ndarray

    def score(self, words: list[bytes]) -> np.ndarray:
        codes, starts = contexts(words)
        return np.add.reduceat(self.rows[self.row_of[codes >> 8], codes & 255].astype(float), starts)


@dataclass
class Totals:
    """Of the training words: tokens, types, and customers, tables, discount and strength of their restaurant;
    and the discount of the restaurants of preceding words."""

    tokens: int
    types: int
    customers: int
    tables: float
    discount: float
    pair_discount: float = 0.5
    strength: float = 10.0

    @property
    def new_table(self) -> float:
        return self.strength + self.discount * self.tables


#: What one batch of words sends for the spelling restaurants.
CODES = pa.schema([("code", pa.int64()), ("n", pa.int64())])


def _customers(spelling, totals: Totals):
    """Customers of the spelling restaurants: one word for each of its tables, which are drawn given
    the spellings; before there are any, each word has one table."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn, sums = 0, None
        for part in batches:
            words, c = as_list(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)
            if not words:
                continue
            tables = np.ones(len(c), np.int64)
            if spelling is not None:
                tables = _word_tables(words, c, spelling.value.score(words), totals)
            codes, starts = contexts(words)
            owners = np.repeat(np.arange(len(words)), np.diff([*starts, len(codes)]))
            drawn += int(tables.sum())
            n = tables[owners]
            if sums is not None:
                codes, n = np.concatenate([sums[0], codes]), np.concatenate([sums[1], n])
            # No code is larger: a task holds the sums of all.
            seen, at = _kinds(codes, CONTEXTS << 8)
            sums = seen, np.bincount(at, n, len(seen)).astype(np.int64)
        if sums is not None:
            # A negative code carries the number of tables.
            yield batch(CODES, [-1], [drawn])
            for at in range(0, len(sums[0]), 100_000):
                yield batch(CODES, *(x[at : at + 100_000] for x in sums))

    return counted


def _rng(words: list[bytes], salt: int) -> np.random.Generator:
    return np.random.default_rng([zlib.crc32(b"\n".join(words)), salt])


def _word_tables(words: list[bytes], c: np.ndarray, log_base: np.ndarray, totals: Totals) -> np.ndarray:
    return _draws_of_words(words, c, log_base, totals, [0])[0]


def _draws_of_words(
    words: list[bytes], c: np.ndarray, log_base: np.ndarray, totals: Totals, salts: list[int]
) -> list[np.ndarray]:
    alpha = totals.new_table * 10.0 ** np.maximum(log_base, -300)
    return draws_of_tables(c, alpha, totals.discount, [_rng(words, salt) for salt in salts])


RESTAURANTS = pa.schema([("level", pa.int64()), ("context", pa.int64()), ("values", pa.binary())])


def _predictive(c, t, of, total_c, total_t, above, level):
    """Chance of each type: its own share, and the parent's for new tables."""
    d, s = DISCOUNTS[level], STRENGTHS[level]
    return (c - d * t + (s + d * total_t[of]) * above) / (s + total_c[of])


def seat_below(codes: np.ndarray, n: np.ndarray, root: np.ndarray, seed: int) -> list[tuple[int, int, np.ndarray]]:
    """Gibbs sampling of all restaurants below one preceding byte.

    `codes` (context << 8 | byte) are the types of the longest contexts with `n` customers each, and
    `root` is the root's chance of each byte. Returned are averaged predictive rows (level, context,
    256 chances), and as level 0 the tables of the shortest context, which are the root's customers.
    """
    rng = np.random.default_rng([seed, len(codes)])
    byte3 = codes & 255
    rooms3, of3 = np.unique(codes >> 8, return_inverse=True)
    types2, up3 = np.unique((codes >> 8 + CLASS_BITS) << 8 | byte3, return_inverse=True)
    byte2 = types2 & 255
    rooms2, of2 = np.unique(types2 >> 8, return_inverse=True)
    byte1, up2 = np.unique(byte2, return_inverse=True)
    of1, room1 = np.zeros(len(byte1), np.int64), int(codes[0] >> 8 + 2 * CLASS_BITS)
    room2_of3 = np.searchsorted(rooms2, rooms3 >> CLASS_BITS)

    c3, t3 = n.astype(np.int64), np.minimum(n, 1).astype(np.int64)
    t2, t1 = np.ones(len(types2), np.int64), np.ones(len(byte1), np.int64)
    sums = [np.zeros((rooms, 256)) for rooms in (1, len(rooms2), len(rooms3))]
    tables = np.zeros(256)
    total = lambda values, of, rooms: np.bincount(of, values, rooms)
    for sweep in range(BURN_IN + DRAWS):
        c2 = total(t3, up3, len(types2)).astype(np.int64)
        c1 = total(t2, up2, len(byte1)).astype(np.int64)
        t2, t1 = np.minimum(t2, c2), np.minimum(t1, c1)
        p1 = _predictive(c1, t1, of1, total(c1, of1, 1), total(t1, of1, 1), root[byte1], 1)
        p2 = _predictive(c2, t2, of2, total(c2, of2, len(rooms2)), total(t2, of2, len(rooms2)), p1[up2], 2)
        room_t3 = total(t3, of3, len(rooms3))
        t3 = draw_tables(c3, (STRENGTHS[3] + DISCOUNTS[3] * room_t3[of3]) * p2[up3], DISCOUNTS[3], rng)
        c2 = total(t3, up3, len(types2)).astype(np.int64)
        room_t2 = total(np.minimum(t2, c2), of2, len(rooms2))
        t2 = draw_tables(c2, (STRENGTHS[2] + DISCOUNTS[2] * room_t2[of2]) * p1[up2], DISCOUNTS[2], rng)
        c1 = total(t2, up2, len(byte1)).astype(np.int64)
        t1 = draw_tables(c1, (STRENGTHS[1] + DISCOUNTS[1] * np.minimum(t1, c1).sum()) * root[byte1], DISCOUNTS[1], rng)
        if sweep < BURN_IN:
            continue
        tables[byte1] += t1
        rows = root[None, :]
        above = np.zeros(1, np.int64)
        levels = (
            (1, c1, t1, of1, byte1, 1, above),
            (2, c2, t2, of2, byte2, len(rooms2), np.zeros(len(rooms2), np.int64)),
            (3, c3, t3, of3, byte3, len(rooms3), room2_of3),
        )
        for level, c, t, of, byte, rooms, parent in levels:
            d, s = DISCOUNTS[level], STRENGTHS[level]
            held = s + total(c, of, rooms)
            rows = rows[parent] * ((s + d * total(t, of, rooms)) / held)[:, None]
            np.add.at(rows, (of, byte), (c - d * t) / held[of])
            sums[level - 1] += rows
    out = [(1, room1, sums[0][0])]
    out += [(2, int(room), row) for room, row in zip(rooms2, sums[1], strict=True)]
    out += [(3, int(room), row) for room, row in zip(rooms3, sums[2], strict=True)]
    return [(0, room1, tables / DRAWS)] + [(level, room, row / DRAWS) for level, room, row in out]


def _seated(root: np.ndarray):
    def seated(types: pa.Table) -> pa.Table:
        codes = types["code"].to_numpy()
        order = np.argsort(codes)
        found = seat_below(codes[order], types["n"].to_numpy()[order], root, int(codes.min() >> 18))
        levels, rooms, values = zip(*found, strict=True)
        return pa.Table.from_batches([batch(RESTAURANTS, levels, rooms, [v.astype("<f4").tobytes() for v in values])])

    return seated


def _root_chances(customers: np.ndarray, seed: int = 0) -> np.ndarray:
    """Averaged predictive chances of the root restaurant, over uniform bytes."""
    rng, c = np.random.default_rng(seed), np.ceil(customers).astype(np.int64)
    d, s = DISCOUNTS[0], STRENGTHS[0]
    t, out = np.minimum(c, 1), np.zeros(256)
    for sweep in range(BURN_IN + DRAWS):
        t = draw_tables(c, np.full(256, (s + d * t.sum()) / 256), d, rng)
        if sweep >= BURN_IN:
            out += (c - d * t + (s + d * t.sum()) / 256) / (s + c.sum())
    return out / DRAWS


def _learn_spelling(customers: DataFrame, tables: np.ndarray | None) -> tuple[Spelling, np.ndarray]:
    """Seat the spelling restaurants, each preceding byte's on its own, and gather their chances.

    A group has at most 2^18 types, whatever the corpus, and the gathered rows are bounded likewise.
    """
    if tables is None:
        byte = (F.col("code") % 256).alias("byte")
        kinds = customers.select(byte, F.shiftright("code", 18)).distinct().groupBy("byte").count().collect()
        tables = np.zeros(256)
        for b, n in kinds:
            tables[b] = n
    root = _root_chances(tables)
    found = (
        customers.groupBy(F.shiftright("code", 18).alias("before"))
        .applyInArrow(_seated(root), "level long, context long, values binary")
        .collect()
    )
    tables = np.zeros(256)
    rows, row_of = [root], np.zeros(CONTEXTS, np.int32)
    for level, context, values in sorted(found):
        values = np.frombuffer(values, "<f4").astype(float)
        if level == 0:
            tables += values
        else:
            span = 1 << CLASS_BITS * (3 - level)
            row_of[context * span : (context + 1) * span] = len(rows)
            rows.append(values)
    logs = np.log10(np.maximum(np.array(rows), 1e-30)).astype(np.float32)
    return Spelling(logs, row_of), tables


def _chances(spelling: Spelling, totals: Totals, words: list[bytes], k: np.ndarray) -> np.ndarray:
    """log10 of what the word restaurant, with `k` customers each, gives the words."""
    log_base = spelling.score(words)
    held = totals.strength + totals.customers
    new = np.log10(totals.new_table / held) + log_base
    own = np.zeros(len(words))
    known = np.flatnonzero(k > 0)
    some = [words[i] for i in known]
    for t in _draws_of_words(some, k[known], log_base[known], totals, list(range(1, DRAWS + 1))):
        own[known] += (k[known] - totals.discount * t) / held / DRAWS
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(own), new * np.log(10)) / np.log(10)


#: Words by part, a share of all words: a row for each word, with its training tokens, its customers in the word
#: restaurant and the tables of its restaurant as a preceding word; and a row for each block, with the
#: numbers of its words here and there.
WORDS = pa.schema(
    [
        ("part", pa.int64()),
        ("seq", pa.int64()),
        ("word", pa.binary()),
        ("c", pa.int64()),
        ("k", pa.int64()),
        ("t", pa.int64()),
        ("block", pa.int64()),
        ("seqs", pa.binary()),
        ("locals", pa.binary()),
    ]
)
WORDS_SCHEMA = "part long, seq long, word binary, c long, k long, t long, block long, seqs binary, locals binary"


def _gathered(rows: pa.Table) -> pa.Table:
    """The words of one part. At first each customer of a pair has a table of its own."""
    part = rows["part"][0].as_py()
    coded = rows["word"].combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    seq, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    c = np.bincount(seq, rows["n_train"].to_numpy(), len(words)).astype(np.int64)
    blocks, local = rows["block"].to_numpy(), rows["local"].to_numpy()
    order = np.lexsort((seq, blocks))
    blocks, seq, local = blocks[order], seq[order], local[order]
    cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
    size, places = len(words), len(cuts)
    spans = list(zip(cuts, [*cuts[1:], len(blocks)], strict=True))
    seqs = [packed_numbers(np.diff(seq[a:b], prepend=0).astype("<u4")) for a, b in spans]
    locals_ = [packed_numbers(local[a:b].astype("<u4")) for a, b in spans]
    none = [None] * size
    return pa.Table.from_batches(
        [
            batch(WORDS, [part] * size, range(size), words, c, c, c, *[none] * 3),
            batch(WORDS, [part] * places, *[[None] * places] * 5, blocks[cuts], seqs, locals_),
        ]
    )


def _by_seq(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The words of a part in order, and its blocks."""
    words = rows.filter(pa.compute.is_valid(rows["word"])).sort_by("seq")
    return words, rows.filter(pa.compute.is_null(rows["word"]))


#: What a block is told: of its words in a part (seqs, locals, log10 chances, training tokens, tables), or of its
#: pairs in a shard.
TOLD = pa.schema(
    [("of", pa.int64()), ("part", pa.int64()), ("shard", pa.int64()), *((x, pa.binary()) for x in ("seqs", "locals", "lp", "c", "t"))]
)
TOLD_SCHEMA = "of long, part long, shard long, seqs binary, locals binary, lp binary, c binary, t binary"


def _told_words(spelling, totals: Totals):
    def told(rows: pa.Table) -> pa.Table:
        words, places = _by_seq(rows)
        c, k, t = (words[x].to_numpy() for x in ("c", "k", "t"))
        names, lp = as_list(words["word"]), np.zeros(len(c))
        for at in range(0, len(c), 10_000):
            some = slice(at, at + 10_000)
            lp[some] = _chances(spelling.value, totals, names[some], k[some])
        seqs = places["seqs"].to_pylist()
        at = [np.cumsum(unpacked_numbers(x, "<u4"), dtype=np.int64) for x in seqs]
        size = len(seqs)
        return pa.Table.from_batches(
            [
                batch(
                    TOLD,
                    places["block"].to_pylist(),
                    places["part"].to_pylist(),
                    [None] * size,
                    seqs,
                    places["locals"].to_pylist(),
                    *([packed_numbers(v[x]) for x in at] for v in (lp.astype("<f4"), c, t)),
                )
            ]
        )

    return told


@dataclass
class Block:
    """Documents of a block in numbers of its dictionary, and its pairs of words ordered by key."""

    docs: pa.Table
    texts: list[bytes]
    sizes: np.ndarray
    before: np.ndarray
    word: np.ndarray
    key: np.ndarray
    #: The pair of each token.
    of: np.ndarray
    #: Words of the dictionary.
    words: int


def _block(rows: pa.Table) -> Block:
    """Of rows that hold `ids`, or `local` and `key`: the hash of a word, or as bytes those of the words from there on."""
    is_doc = pa.compute.is_valid(rows["ids"])
    docs, listed = rows.filter(is_doc), rows.filter(pa.compute.invert(is_doc)).sort_by("local")
    alone = pa.types.is_integer(listed["key"].type)
    hashes = listed["key"].to_numpy().view(np.uint64) if alone else np.frombuffer(b"".join(as_list(listed["key"])), "<u8")
    texts = as_list(docs["ids"])
    sizes = np.array([len(x) // 4 for x in texts], np.int64)
    ids = np.frombuffer(b"".join(texts), "<u4")
    ends = np.cumsum(sizes)
    codes = np.concatenate([[0], ids[:-1]])
    codes[ends - sizes] = ids[ends - 1]
    codes *= len(hashes)
    codes += ids
    kinds, of = _kinds(codes, len(hashes) ** 2)
    before, word = (kinds // len(hashes)).astype(np.int32), (kinds % len(hashes)).astype(np.int32)
    del codes, kinds
    key = mixed(hashes[before], hashes[word])
    order = np.argsort(key)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return Block(docs, texts, sizes, before[order], word[order], key[order], place[of], len(hashes))


def _kinds(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, all below `most`, in order, and which one each is. The array itself is sorted if it can be."""
    bits = len(codes).bit_length()
    if (most - 1).bit_length() + bits > 63:
        return np.unique(codes, return_inverse=True)
    codes <<= bits
    codes |= np.arange(len(codes))
    codes.sort()
    places = (codes & ((1 << bits) - 1)).astype(np.int32)
    codes >>= bits
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    of = np.empty(len(codes), np.int32)
    of[places] = np.cumsum(new, dtype=np.int32) - 1
    return codes[new], of


SENT = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])


def _sent_pairs(shards: int):
    """The pairs of a block with their training counts, by shard: equal stretches of keys."""

    def sent(rows: pa.Table) -> pa.Table:
        block = _block(rows)
        learned = np.repeat(block.docs["train"].to_numpy(zero_copy_only=False).astype(float), block.sizes)
        n = np.bincount(block.of, learned, len(block.key)).astype("<u4")
        shard = (((block.key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        spans = list(zip(cuts, [*cuts[1:], len(shard)], strict=True))
        keys = [packed_numbers(np.diff(block.key[a:b], prepend=np.uint64(0))) for a, b in spans]
        return pa.Table.from_batches(
            [batch(SENT, shard[cuts], [rows["block"][0].as_py()] * len(cuts), keys, [packed_numbers(n[a:b]) for a, b in spans])]
        )

    return sent


SUMMED = pa.schema([("of", pa.int64()), ("shard", pa.int64()), ("c", pa.binary()), ("once", pa.int64()), ("twice", pa.int64())])


def _summed_pairs(rows: pa.Table) -> pa.Table:
    """For each block the corpus's counts of its pairs, doubled; odd where the block speaks for the pair."""
    keys = [np.cumsum(unpacked_numbers(x, "<u8"), dtype=np.uint64) for x in rows["keys"].to_pylist()]
    n = np.concatenate([unpacked_numbers(x, "<u4") for x in rows["n"].to_pylist()])
    _, first, of = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(of, n, len(first)).astype(np.int64)
    told = 2 * total[of]
    told[first] += 1
    ends = np.cumsum([len(x) for x in keys])
    out = [packed_numbers(told[end - len(x) : end]) for x, end in zip(keys, ends, strict=True)]
    once, twice = (total == 1).sum(), (total == 2).sum()
    rest = [0] * (len(keys) - 1)
    return pa.Table.from_batches([batch(SUMMED, rows["block"], rows["shard"], out, [once, *rest], [twice, *rest])])


def _told(block_words: int, told: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    """Rows on words, log10 chances, training tokens and tables of the block's words, and rows on pairs.

    Of `block_words` words, or more if there are rows on more."""
    rows = told.to_pylist()
    about = [r for r in rows if r["shard"] is None]
    places = [unpacked_numbers(r["locals"], "<u4") for r in about]
    size = max([block_words, *(int(x.max(initial=0)) + 1 for x in places)])
    lp, c, t = np.zeros(size), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r, at in zip(about, places, strict=True):
        lp[at], c[at], t[at] = unpacked_numbers(r["lp"], "<f4"), unpacked_numbers(r["c"], "<i8"), unpacked_numbers(r["t"], "<i8")
    return about, lp, c, t, sorted((r for r in rows if r["shard"] is not None), key=lambda r: r["shard"])


#: From a block: for a part the customers and tables of its words by the pairs the block speaks for; for
#: itself, as a part of none, counts and tables of its pairs.
SEATED = pa.schema([("of", pa.int64()), ("part", pa.int64()), ("seqs", pa.binary()), ("c", pa.binary()), ("t", pa.binary())])


def _seated_pairs(totals: Totals):
    """Draw the tables of all pairs of a block, given the word restaurant and the tables of preceding words."""

    def seated(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = _block(rows)
        size = block.words
        about, lp, _, t, pairs = _told(size, told)
        c = np.concatenate([unpacked_numbers(r["c"], "<i8") for r in pairs])
        c, speaks = c >> 1, c & 1
        alpha = (PAIR_STRENGTH + totals.pair_discount * t[block.before]) * 10.0 ** np.maximum(lp[block.word], -300)
        drawn = draw_tables(c, alpha, totals.pair_discount, Keyed(block.key))
        k = np.bincount(block.word, drawn * speaks, size).astype(np.int64)
        t = np.bincount(block.before, drawn * speaks, size).astype(np.int64)
        at = [unpacked_numbers(r["locals"], "<u4") for r in about]
        out = batch(
            SEATED,
            [rows["block"][0].as_py()] * (len(about) + 1),
            [*(r["part"] for r in about), None],
            [*(r["seqs"] for r in about), None],
            [*(packed_numbers(k[x]) for x in at), packed_numbers(c)],
            [*(packed_numbers(t[x]) for x in at), packed_numbers(drawn)],
        )
        return pa.Table.from_batches([out])

    return seated


def _reseated_words(rows: pa.Table, seated: pa.Table) -> pa.Table:
    """The words of a part with their new customers and tables, added up over all blocks."""
    words, places = _by_seq(rows)
    k, t = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for r in seated.to_pylist():
        at = np.cumsum(unpacked_numbers(r["seqs"], "<u4"), dtype=np.int64)
        k[at] += unpacked_numbers(r["c"], "<i8")
        t[at] += unpacked_numbers(r["t"], "<i8")
    for name, values in (("k", k), ("t", t)):
        words = words.set_column(words.schema.get_field_index(name), name, pa.array(values))
    return pa.concat_tables([words.cast(WORDS), places.cast(WORDS)])


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _grouped(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the codes ordered by code and then by place, and the number and start of each one's group
    in that order."""
    size = len(codes)
    bits = size.bit_length()
    if int(codes.max()).bit_length() + bits < 64:
        packed = np.sort(codes << bits | np.arange(size))
        places = packed & ((1 << bits) - 1)
    else:
        places = np.argsort(codes, kind="stable")
    ordered = codes[places]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    number = np.cumsum(new) - 1
    return places, number, np.flatnonzero(new)[number]


def _seen_before(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many marks come before each one in its group, whose start is given."""
    earlier = np.cumsum(marks) - marks
    return earlier - earlier[starts]


def chained(ids: np.ndarray, sizes: np.ndarray, lp: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each text, a product of predictive chances in reading order.

    `ids` are the words of all texts one after the other, `sizes` how many each text has, and `lp`
    is what the corpus restaurant gives each word; `given` is what the corpus gives each place, knowing the
    preceding word, and takes the place of `lp`. A text has a restaurant of its own below that one, and
    below it one for each preceding word. Both hold only what comes earlier in this text, seated with one
    table per word; each table of the lower one is a customer of the upper one.
    """
    size, first = len(ids), np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin = first[text]
    places, number, starts = _grouped(text * len(lp) + ids)
    word = np.empty(size, np.int64)
    word[places] = number
    before = np.concatenate([[0], word[:-1]])
    before[first] = size + np.arange(len(sizes))
    pair_places, _, pair_starts = _grouped(before * size + word)
    pairs, again = np.empty(size, np.int64), np.empty(size, np.int64)
    pairs[pair_places] = np.arange(size) - pair_starts
    again[places] = np.arange(size) - starts
    new_pair, new_word = (pairs == 0).astype(np.int64), (again == 0).astype(np.int64)

    # The restaurant of a preceding word has a customer for each time that word came before.
    follower = np.minimum(places + 1, size - 1)
    inside = (places + 1 < size) & (text[follower] == text[places])
    held2, tables2 = np.zeros(size, np.int64), np.zeros(size, np.int64)
    held2[follower[inside]] = again[places[inside]]
    tables2[follower[inside]] = _seen_before(new_pair[follower] * inside, starts)[inside]

    customers = np.empty(size, np.int64)
    customers[places] = _seen_before(new_pair[places], starts)
    held1, tables1 = _seen_before(new_pair, begin), _seen_before(new_word, begin)

    above = lp[ids] if given is None else given
    for level, c, held, tables in ((0, customers, held1, tables1), (1, pairs, held2, tables2)):
        d, s = TEXT_DISCOUNTS[level], TEXT_STRENGTHS[level]
        own = np.maximum(c - d, 0) / (s + held)
        new = (s + d * tables) / (s + held)
        known = own > 0
        above = above + np.log10(new)
        above[known] = np.log10(own[known] + 10.0 ** np.maximum(above[known], -300))
    return np.add.reduceat(above, first)


def _in_parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `most` words each; a text is never cut."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield at, end
        at = end


def _score_block(totals: Totals):
    def scored(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = _block(rows)
        docs, texts, sizes, before = block.docs, block.texts, block.sizes, block.before
        _, lp, c, t, (pairs,) = _told(block.words, told)
        base = np.log10((c + 1) / (totals.tokens + 1 * (totals.types + 1)))
        # A preceding word has as many customers as training tokens: each is followed by one, the end by a first word.
        d, s = totals.pair_discount, PAIR_STRENGTH
        own = (unpacked_numbers(pairs["c"], "<i8") - d * unpacked_numbers(pairs["t"], "<i8")) / (s + c[before])
        given = lp[block.word] + np.log10((s + d * t[before]) / (s + c[before]))
        known = own > 0
        given[known] = np.log10(own[known] + 10.0 ** np.maximum(given[known], -300))
        ends = np.cumsum(sizes)
        known, bases, scores = np.zeros(len(sizes), np.int64), np.zeros(len(sizes)), np.zeros(len(sizes))
        for low, high in _in_parts(sizes, WORDS_AT_ONCE):
            ids = np.frombuffer(b"".join(texts[low:high]), "<u4").astype(np.int64)
            starts = np.cumsum(sizes[low:high]) - sizes[low:high]
            known[low:high] = np.add.reduceat((c[ids] > 0).astype(np.int64), starts)
            bases[low:high] = np.add.reduceat(base[ids], starts)
            places = block.of[ends[low] - sizes[low] : ends[high - 1]]
            scores[low:high] = chained(ids, sizes[low:high], lp, given[places])
        return pa.Table.from_batches(
            [
                batch(
                    RESULT,
                    docs["doc_id"].to_pylist(),
                    docs["held"].to_pylist(),
                    sizes,
                    known,
                    [totals.tokens] * len(sizes),
                    bases,
                    scores,
                )
            ]
        )

    return scored


def _suggested(once: int, twice: int) -> float:
    """The discount that the counts of counts suggest, as in Kneser-Ney smoothing."""
    return min(0.9, max(0.1, round(once / max(1, once + 2 * twice), 3)))


def _learn_words(words: DataFrame, totals: Totals, rounds: int, spelling=None, tables: np.ndarray | None = None):
    """Seat the word restaurant and its spellings, given the customers `k` of each word."""
    spark = words.sparkSession
    known = words.where("word is not null and k > 0").select("word", "k")
    totals.customers, once, twice = known.agg(
        F.coalesce(F.sum("k"), F.lit(0)), F.count_if(F.col("k") == 1), F.count_if(F.col("k") == 2)
    ).first()
    totals.discount = _suggested(once, twice)
    for _ in range(rounds):
        counted = stored(
            known.mapInArrow(_customers(spelling, totals), "code long, n long")
            .groupBy("code")
            .agg(F.sum("n").alias("n")),
            "lm-spellings",
        )
        drawn = counted.where("code = -1").first()
        totals.tables = float(drawn["n"]) if drawn else 0.0
        learned, tables = _learn_spelling(counted.where("code >= 0"), tables)
        spelling = spark.sparkContext.broadcast(learned)
    return spelling, tables


def scored_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Learned from the rows with crc32(doc_id) mod 7 other than 2; scores are log10 probabilities of the
    whole text with its end, word after word given the text's own past. Each task codes its documents as
    numbers of a dictionary of its own, in blocks that are stored by their number and never shuffled.
    Dictionaries are summed up by shares of the words, pairs of words by shares of their keys (64-bit
    hashes), and what is learned of both comes back to their block in the order in which it was sent: no token
    is shuffled on its own and no vocabulary is broadcast. What reaches
    the driver are totals and the spelling rows, whose number is bounded.

    A null text is empty: its end alone. A null id is neither learned from nor held out. Repeated rows
    give repeated rows, an empty table none; other columns are not read.
    """
    spark = docs.sparkSession
    workers_import(spark)
    slim = docs.select(F.col("doc_id").cast("long"), "text", in_training().alias("train"))
    coded = stored_by(slim.mapInArrow(_code, CODED_SCHEMA), "block", "lm-coded")
    listed = coded.where("word is not null")
    rows, tokens = listed.agg(F.count("*"), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.expr(f"pmod(hash(word), {max(least, rows // PART_ROWS)})").cast("long").alias("part")
    words = stored_by(
        listed.select(part, "word", "block", "local", "n_train").groupBy("part").applyInArrow(_gathered, WORDS_SCHEMA),
        "part",
        "lm-words",
    )
    types = words.where("c > 0").count()
    totals = Totals(tokens, types, tokens, float(types), 0.5)

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held")
    blocks = coded.where("word is null").select("block", "doc_id", "train", held, "ids", "local", "key")
    pairs = stored(
        blocks.groupBy("block")
        .applyInArrow(_sent_pairs(max(least, tokens // SHARD_TOKENS)), "shard long, block long, keys binary, n binary")
        .groupBy("shard")
        .applyInArrow(_summed_pairs, "of long, shard long, c binary, once long, twice long"),
        "lm-pairs",
    )
    once, twice = pairs.agg(F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first()
    totals.pair_discount = _suggested(once, twice)

    spelling, tables = _learn_words(words, totals, ROUNDS)
    told = words.groupBy("part").applyInArrow(_told_words(spelling, totals), TOLD_SCHEMA)
    told = told.unionByName(pairs.select("of", "shard", "c"), allowMissingColumns=True)
    seated = stored(
        blocks.groupBy("block")
        .cogroup(told.groupBy("of"))
        .applyInArrow(_seated_pairs(totals), "of long, part long, seqs binary, c binary, t binary"),
        "lm-seated",
    )
    answers = seated.where("part is not null").select("part", "seqs", "c", "t")
    words = stored_by(
        words.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_reseated_words, WORDS_SCHEMA),
        "part",
        "lm-words",
    )

    totals = replace(totals)
    spelling, _ = _learn_words(words, totals, 1, spelling, tables)
    told = words.groupBy("part").applyInArrow(_told_words(spelling, totals), TOLD_SCHEMA)
    own = seated.where("part is null").select("of", F.lit(0).cast("long").alias("shard"), "c", "t")
    return (
        blocks.groupBy("block")
        .cogroup(told.unionByName(own, allowMissingColumns=True).groupBy("of"))
        .applyInArrow(
            _score_block(totals),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,"
            " score double",
        )
    )
