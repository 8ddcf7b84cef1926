"""BPE encoding and decoding by speculation and verification.

A word is first cut greedily into the longest vocabulary strings. That proposal
is what merging gives exactly if each token comes out alone from its own bytes
and each two neighbours come out as these two from theirs. All neighbours of a
batch's new words are tested at once, by undoing merges from the latest on; only
words that fail are merged step by step.

Rows: a null or empty text has no tokens and decodes to the empty text. Other
columns, repeated rows and their order stay; an output column replaces one of the
same name. Texts are encoded whole, however long.
"""

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import vocabulary as v
from roadstream.llm.store import small_batches

SLICE = 256  # texts handled at once within a batch
FEW = 64  # words that are no longer worth a step of all at once


def propose(word: bytes, tables: dict) -> list[int]:
    """Greedy longest match."""
    get, longest = tables["ids"].get, tables["longest"]
    if (token := get(word)) is not None:
        return [token]
    tokens, start, end = [], 0, len(word)
    while start < end:
        stop = start + longest[word[start]]
        if stop > end:
            stop = end
        while (token := get(word[start:stop])) is None:
            stop -= 1
        tokens.append(token)
        start = stop
    return tokens


def propose_all(words: list[bytes], tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """``propose`` of many words: all tokens, and the place of each one's word.

    All words go down the trie of the vocabulary a byte at a time. One that finds no way
    on takes the longest string it passed and starts anew behind it. The last few words
    are cut one by one.
    """
    base, parent, token = tables["base"], tables["parent"], tables["token"]
    raw = np.frombuffer(b"\0".join([*words, b""]), np.uint8).astype(np.int16)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stops = np.cumsum(size) - 1
    raw[stops] = v.END
    found = np.full(len(raw), -1, np.int32)  # tokens by the place of their first byte
    begin = stops - size + 1
    begin = begin[raw[begin] != v.END]
    at, node = begin.copy(), np.zeros(len(begin), np.int64)
    longest, after = node.copy(), begin.copy()
    while len(begin) > FEW:
        child = base[node] + raw[at]
        on = parent[child] == node
        at += on
        node = child * on
        passed = token[child]
        hit = on & (passed >= 0)
        np.copyto(longest, passed, where=hit)
        np.copyto(after, at, where=hit)
        halted = np.flatnonzero(~on)
        if not len(halted):
            continue
        found[begin[halted]] = longest[halted]
        start = after[halted]
        begin[halted] = at[halted] = start
        if (done := raw[start] == v.END).any():
            left = np.ones(len(begin), bool)
            left[halted[done]] = False
            begin, at, node, longest, after = (x[left] for x in (begin, at, node, longest, after))
    for start in begin.tolist():
        word = np.searchsorted(stops, start)
        rest = words[word][start - stops[word] :]
        for one in propose(rest, tables):
            found[start] = one
            start += len(tables["token_bytes"][one])
    is_token = found >= 0
    return found[is_token], np.repeat(np.arange(len(words), dtype=np.int32), size)[is_token]


def compatible(first: np.ndarray, second: np.ndarray, tables: dict) -> np.ndarray:
    """Whether merging the joint bytes of two tokens leaves just these two.

    Undoes the later merge of the two tokens at the border, again and again. If
    the two that then meet have a merge of a lower rank than the one undone, it
    would have come first. On equal ranks the left one of two places wins.
    """
    keys, ranks = tables["pair_keys"], tables["pair_ranks"]
    rank, left, right = tables["rank"], tables["left"], tables["right"]
    good = np.ones(len(first), bool)
    rows = np.arange(len(first))
    a, b = first.astype(np.int64), second.astype(np.int64)
    limit = np.full(len(a), v.NO_RANK, np.int64)
    while len(rows):
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        met = (keys[at] == key) & (ranks[at] < limit)
        good[rows[met]] = False
        go_on = ~met & ((rank[a] >= 0) | (rank[b] >= 0))
        rows, a, b = rows[go_on], a[go_on], b[go_on]
        undo_left = rank[a] > rank[b]
        limit = np.where(undo_left, rank[a], rank[b] + 1)
        a, b = np.where(undo_left, right[a], a), np.where(undo_left, b, left[b])
    return good


def encode_words(words: list[bytes], tables: dict) -> list[list[int]]:
    """Token ids of each pre-token."""
    if not tables["one_way"]:  # a token with two merges has no single history
        return v.merge_all(words, tables)
    flat, owner = propose_all(words, tables)
    failed = np.zeros(len(words), bool)
    failed[owner[~tables["alone"][flat]]] = True
    within = owner[1:] == owner[:-1]
    fits = compatible(flat[:-1][within], flat[1:][within], tables)
    failed[owner[1:][within][~fits]] = True
    upto = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
    values = flat.tolist()
    coded = [values[a:b] for a, b in zip([0, *upto], upto, strict=False)]
    again = np.flatnonzero(failed).tolist()
    for i, tokens in zip(again, v.merge_all([words[i] for i in again], tables), strict=True):
        coded[i] = tokens
    return coded


def encode_texts(texts: list[str | None], tables: dict) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    known: dict[str, bytes] = v.kept(tables, "words")
    special = v.special_pattern(tables)
    parts = [[t] if special is None else special.split(t) for t in (t or "" for t in texts)]
    pieces = [[v.PIECES.findall(p) for p in own[::2]] for own in parts]
    seen = set().union(*(part for own in pieces for part in own))
    fresh = list(seen.difference(known))
    coded_words = encode_words([w.encode() for w in fresh], tables)
    for word, tokens in zip(fresh, coded_words, strict=True):
        known[word] = struct.pack(f"<{len(tokens)}I", *tokens)
    names = {s: np.array([i], "<u4").tobytes() for s, i in tables["specials"].items()}
    out = []
    for own, cut in zip(parts, pieces, strict=True):
        coded = [b"".join([known[p] for p in part]) for part in cut]
        for k, name in enumerate(own[1::2]):
            coded[k] += names[name]
        out.append(b"".join(coded))
    return out


def decode_ids(packed: bytes | None, tables: dict) -> str:
    """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
    token_bytes = tables["token_bytes"]
    ids = np.frombuffer(packed or b"", "<u4").tolist()
    return b"".join([token_bytes[i] for i in ids]).decode("utf-8", "replace")


def broadcast_tables(spark: SparkSession, path: str):
    """The vocabulary's tables for all workers; their size is that of the file."""
    small_batches(spark)
    return spark.sparkContext.broadcast(v.read_tables(path))


def _sliced(array: pa.Array, one, kind: pa.DataType) -> pa.Array:
    """``one`` (values to values) over an array, a slice at a time."""
    done = [
        pa.array(one(array.slice(i, SLICE).to_pylist()), kind)
        for i in range(0, len(array), SLICE)
    ]
    return pa.concat_arrays(done) if done else pa.array([], kind)


def encoded(text: Column | str, shared) -> Column:
    """Packed ids (little-endian unsigned 32-bit, binary) of a text column."""

    @F.arrow_udf("binary")
    def encode_udf(texts: pa.Array) -> pa.Array:
        tables = shared.value
        return _sliced(texts, lambda own: encode_texts(own, tables), pa.binary())

    return encode_udf(text)


def decoded(packed: Column | str, shared) -> Column:
    """Text of a column of packed ids."""

    @F.arrow_udf("string")
    def decode_udf(ids: pa.Array) -> pa.Array:
        tables = shared.value
        return _sliced(ids, lambda own: [decode_ids(i, tables) for i in own], pa.string())

    return decode_udf(packed)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the packed token ids of ``text``."""
    return df.withColumn(ids, encoded(text, broadcast_tables(df.sparkSession, path)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of packed token ids."""
    return df.withColumn(text, decoded(ids, broadcast_tables(df.sparkSession, path)))


def round_trip(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "ids",
    back: str = "decoded",
    packed: bool = True,
) -> DataFrame:
    """Adds ids, packed or as an array of int, and the text decoded from them, in one
    pass over the rows."""
    shared = broadcast_tables(df.sparkSession, path)

    @F.arrow_udf(f"ids {'binary' if packed else 'array<int>'}, decoded string")
    def both_udf(texts: pa.Array) -> pa.Array:
        tables = shared.value
        coded = _sliced(texts, lambda own: encode_texts(own, tables), pa.binary())
        plain = _sliced(coded, lambda own: [decode_ids(i, tables) for i in own], pa.string())
        kept = coded if packed else _unpacked(coded)
        return pa.StructArray.from_arrays([kept, plain], ["ids", "decoded"])

    both = df.withColumn("_both", both_udf(text))
    return both.withColumns({ids: F.col("_both.ids"), back: F.col("_both.decoded")}).drop("_both")


def _unpacked(coded: pa.Array) -> pa.Array:
    """Packed ids as lists of int, over the same bytes."""
    ends = np.frombuffer(coded.buffers()[1], np.int32)[: len(coded) + 1]
    flat = pa.Array.from_buffers(
        pa.int32(), int(ends[-1]) // 4 if len(coded) else 0, [None, coded.buffers()[2]]
    )
    return pa.ListArray.from_arrays(pa.array(ends // 4), flat)


def n_tokens(packed: Column | str) -> Column:
    """Number of tokens in packed ids."""
    column = F.col(packed) if isinstance(packed, str) else packed
    return (F.octet_length(column) / 4).cast("long")

