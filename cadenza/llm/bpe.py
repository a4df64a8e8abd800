"""Byte-level BPE over a corpus: every distinct word is merged once.

Documents are cut into blocks of some megabytes. A block explodes into its distinct
pre-tokens, numbered as they first occur, and its documents' sequences of those numbers, which
are the positions. One scan cuts both and one shuffle deals both: sequences by their block, the
words of all blocks by ranges of their hashes. There each distinct word is encoded once, and its
ids go back to every block that holds it, where the documents are put together by position. Words,
ids and sequences travel as compressed runs, one for a block and range, and none of them is
stored. Decoding joins ids with the token-byte table.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadenza.llm.common import give_back, giving_back, text_or_empty

BLOCK_BYTES = 24 << 20
#: Text of a range of word hashes on average, the least and the most ranges: a block has a run of
#: words for each, so there are to be fewer ranges than a block has words.
RANGE_BYTES, LEAST_RANGES, MOST_RANGES = 64 << 20, 64, 1 << 13
#: Words that a task remembers at a time; it starts anew beyond that, so its memory has a bound.
KNOWN_WORDS = 1 << 21
#: Tokens decoded at a time.
DECODE_TOKENS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost among equals."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is merged away
    before = list(range(-1, n - 1))
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(queue)
    while queue:
        _, i, stop = heappop(queue)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heappush(queue, (r, i, end[stop]))
        if i and (r := ranks.get(word[before[i] : stop])) is not None:
            heappush(queue, (r, before[i], stop))
    return [ranks[word[i : end[i]]] for i in range(n) if end[i]]


def _packed(data: bytes) -> bytes:
    return zlib.compress(data, 1)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes: small ones leave the upper planes empty."""
    return _packed(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(planes: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(planes), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(flat.T).view("<u4").ravel()


def _join_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], np.uint32)
    head = np.array([len(words)], np.uint32).tobytes()
    return _packed(head + sizes.tobytes() + b"".join(words))


def _split_words(packed: bytes) -> list[bytes]:
    data = zlib.decompress(packed)
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(data, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())]


def _blocks(schema: pa.Schema, pattern: str, ranges: int):
    """Cut a task's rows into blocks of whole documents, and texts into words, once.

    The documents of a block go on as the numbers of its words, under the block's own number;
    a block is told by its task and its place there. Its distinct words go on when it is full, a
    run for each range of hashes, under the range's: -1 and down, as no block has.
    """

    def documents(block: int, rows: pa.RecordBatch, numbers: dict[str, int], find) -> pa.RecordBatch:
        codes = [_planes(np.fromiter(map(numbers.__getitem__, find(t.as_py())), np.uint32)) for t in rows.column(1)]
        none = [pa.nulls(len(codes), schema.field(c).type) for c in ("part", "words")]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block)), rows.column(0), *none, pa.array(codes, pa.binary())], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block, numbers, held, size = TaskContext.get().partitionId() << 32, _numbering(), 0, 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                to = max(at + (not held), int(np.searchsorted(sizes, before + BLOCK_BYTES - size, side="right")))
                if to > at:
                    yield documents(block, batch.slice(at, to - at), numbers, find)
                    held += to - at
                    size += int(sizes[to - 1]) - before
                at = to
                if at < batch.num_rows:
                    yield _block_words(schema, block, numbers, ranges)
                    block, numbers, held, size = block + 1, _numbering(), 0, 0
        if held:
            yield _block_words(schema, block, numbers, ranges)

    return giving_back(cut)


def _numbering() -> dict[str, int]:
    """Numbers what it is asked for, as it first occurs."""
    numbers: dict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def _block_words(schema: pa.Schema, block: int, numbers: dict[str, int], ranges: int) -> pa.RecordBatch:
    """The distinct words of a block and their numbers, a run for each range of hashes."""
    words = [w.encode() for w in numbers]
    hashed = np.array([zlib.crc32(w) % ranges for w in words], np.int64)
    order = np.argsort(hashed, kind="stable")
    at = np.searchsorted(hashed[order], np.arange(ranges + 1))
    some = [k for k in range(ranges) if at[k + 1] > at[k]]
    columns = [
        pa.array([-1 - k for k in some], pa.int64()),
        pa.nulls(len(some), schema.field("id").type),
        pa.array(np.full(len(some), block)),
        pa.array([_join_words([words[i] for i in order[at[k] : at[k + 1]]]) for k in some], pa.binary()),
        pa.array([_planes(order[at[k] : at[k + 1]]) for k in some], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """One row per document: ``id`` and ``ids``, the token ids of its whole text.

    ``pattern`` cuts the text into pre-tokens, each is encoded by itself and there are no
    special tokens. Null and empty texts have no ids. Rows that repeat an id or a text come
    out as often, null ids too; further columns are not read. An empty table gives an empty
    table. ``vocabulary`` must be readable at that path on every executor. ``ranges`` follows
    the bytes of the texts unless given.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    if ranges is None:
        total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        ranges = min(max(total // RANGE_BYTES, LEAST_RANGES), MOST_RANGES)
    cut = T.StructType().add("key", "long").add("id", rows.schema["id"].dataType).add("part", "long").add("words", "binary").add("codes", "binary")
    # one exchange that both readers share, so neither may filter or narrow it: each passes over the other's rows
    dealt = rows.mapInArrow(_blocks(to_arrow_schema(cut), pattern, ranges), cut).repartition("key")
    back = dealt.sortWithinPartitions("key").mapInArrow(_encoder(vocabulary), "part long, codes binary, ids binary")
    out = T.StructType().add("id", rows.schema["id"].dataType).add("ids", T.ArrayType(T.IntegerType()))
    return dealt.groupBy("key").cogroup(back.groupBy("part")).applyInArrow(_assemble, out)


def _encoder(vocabulary: str):
    """Encode the words of each range once; their ids go back to every block that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, now, known = None, None, {}
        for batch in batches:
            batch = batch.filter(batch.column(3).is_valid())
            ranks = ranks or read_ranks(vocabulary)
            for i in range(batch.num_rows):
                if (own := batch.column(0)[i].as_py()) != now:
                    now, known = own, {}
                ids, sizes = [], []
                for word in _split_words(batch.column(3)[i].as_py()):
                    if (found := known.get(word)) is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        found = known[word] = merge_word(word, ranks)
                    ids += found
                    sizes.append(len(found))
                n = np.array([len(sizes)], np.uint32).tobytes()
                packed = _packed(n + np.array(sizes, np.uint32).tobytes()) , _planes(np.array(ids, np.uint32))
                joined = np.array([len(packed[0])], np.uint32).tobytes() + packed[0] + packed[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(i, 1), batch.column(4).slice(i, 1), pa.array([joined], pa.binary())], ["part", "codes", "ids"]
                )

    return giving_back(run)


def _word_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and ids of the words of one block and range."""
    cut = 4 + int(np.frombuffer(packed, np.uint32, 1)[0])
    sizes = np.frombuffer(zlib.decompress(packed[4:cut]), np.uint32)[1:]
    return sizes.astype(np.int64), _numbers(packed[cut:]).astype(np.int32)


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[shift + np.arange(len(shift))]


def _assemble(sequences: pa.Table, words: pa.Table) -> pa.Table:
    """The documents of one block from their word numbers and the words' ids; none of a range."""
    sequences = sequences.filter(pc.is_null(sequences.column("words")))
    numbers, sizes, ids = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for codes, packed in zip(words.column("codes"), words.column("ids")):
        numbers.append(_numbers(codes.as_py()))
        own = _word_ids(packed.as_py())
        sizes.append(own[0]), ids.append(own[1])
    number, size, flat = (np.concatenate(x) for x in (numbers, sizes, ids))
    starts, lengths = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    starts[number], lengths[number] = np.cumsum(size) - size, size
    values, ends = [np.zeros(0, np.int32)], [0]
    for codes in sequences.column("codes"):
        own = _numbers(codes.as_py())
        values.append(_gather(flat, starts[own], lengths[own]))
        ends.append(ends[-1] + len(values[-1]))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), pa.int32()))
    del values, flat, ids
    give_back()
    return pa.table({"id": sequences.column("id"), "ids": lists})


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids.

    The token-byte table has as many rows as the vocabulary, so each task holds it and joins
    by position. Null ids decode to no bytes; an id outside the table is an error.
    """
    shape = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    schema = to_arrow_schema(shape)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            if table is None:
                ranks = read_ranks(vocabulary)
                tokens = [b""] * (max(ranks.values()) + 1)
                for token, rank in ranks.items():
                    tokens[rank] = token
                size = np.array([len(t) for t in tokens], np.int64)
                table = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size
            flat, starts, size = table
            column = batch.column(at)
            texts = []
            for ids in column:
                own, pieces = (ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)), []
                for i in range(0, len(own), DECODE_TOKENS):
                    some = own[i : i + DECODE_TOKENS]
                    pieces.append(_gather(flat, starts[some], size[some]).tobytes())
                texts.append(b"".join(pieces))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], schema=schema)

    return encoded.mapInArrow(giving_back(run), shape)
