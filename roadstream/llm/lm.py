"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs of the training texts are counted over all data. A count is
quantised to a level on a log scale; a Bloom filter holds each n-gram once for every
level up to its own, and probing level after level until one is missing gives the
level back. The filter grows with the corpus: it is cut into segments by hash, each
sized by the level entries counted for it, so that it holds every n-gram. ``fit`` builds
the segments once and stores them.

A second filter of bounded size has an equal share for each segment, which holds the
segment's most frequent n-grams down to some level. It is broadcast, and texts probe it
first; with a small corpus it holds everything. An n-gram found there below that level,
or not at all, may be a rarer one: documents are dealt into parts, and a part sends its
distinct n-grams in doubt to their segments, whose tasks probe the stored bits and
send the levels back. A message has all n-grams of one part and segment, so there are
never more of them than distinct n-grams of parts. Parts and segments grow with the
corpus, and a task holds one at a time. The probability of a word after another is
smoothed towards that of the word: ``(c(uw) + m p(w)) / (c(u) + m)``, with ``c`` from
the filter.

The base score needs exact counts of words. Those of the most frequent words are
broadcast (at most ``EXACT_WORDS``); tokens that are not among them are joined with
the count table.

Rows: a null text counts as empty and has the end token alone. Repeated rows score
alike, and each input partition's go to a part of their own. A very long text stays in
one row of one part. All other columns are dropped. Ties do not arise. Without training
rows N and V are 0. An empty table gives no rows.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm import words
from roadstream.llm.store import stored

FILTER_BITS = 1 << 28  # 32 MB, bound of a segment's mean size
TOP_BITS = 1 << 27  # 16 MB, the filter that is broadcast
EXACT_WORDS = 1 << 18  # 4 MB
LOG_BASE = 1.5
PROBES = 3
BITS_PER_ENTRY = 16  # a missing level is then found in one of 200 cases at most
SMOOTHING = 20.0
DOCS_PER_PART = 1000
TOKENS_PER_SEGMENT = 1 << 20
LEAST_SEGMENTS = 64
SLICE = 128
CHUNK = 1_500_000  # n-grams a task counts before it passes them on

START = np.uint64(0x3C6EF372FE94F82B)
END = np.uint64(0xA54FF53A5F1D36F1)


def token_rows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words then its end; of the tokens before them;
    and the number of tokens of each text."""
    hashes, counts = words.word_hashes(texts)
    ends = np.cumsum(counts)
    tokens = np.insert(hashes, ends, END)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], np.cumsum(counts + 1)[:-1]])] = START
    return tokens, before, counts + 1


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return words.mixed(before * words.GOLDEN + tokens)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Ascending; by a sort, which is several times as fast as np.unique's hashing here."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised count, from 1."""
    return 1 + np.floor(np.log(counts) / np.log(LOG_BASE) + 1e-9).astype(np.int64)


def level_count(levels: np.ndarray) -> np.ndarray:
    """Middle of the whole counts of each level; 0 of level 0."""
    low = np.ceil(LOG_BASE ** (levels - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(LOG_BASE ** (levels * 1.0) - 1e-9) - 1)
    return np.where(levels > 0, (low + high) / 2, 0.0)


def _bit_places(sub: np.ndarray, at: np.ndarray | int, bits: int) -> list[np.ndarray]:
    """Places in its segment of an n-gram (32-bit ``sub``) at a level."""
    with np.errstate(over="ignore"):
        h = words.mixed(sub.astype(np.uint64) + np.uint64(1 << 32) * np.asarray(at, np.uint64))
    step = (h >> np.uint64(40)) | np.uint64(1)
    return [(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]


def segment_bits(counts: np.ndarray) -> int:
    """Bits, a power of two, for n-grams of these counts at all their levels."""
    entries = int(level(counts).sum())
    return 1 << max(12, (BITS_PER_ENTRY * entries - 1).bit_length())


def build_segment(sub: np.ndarray, counts: np.ndarray, bits: int) -> tuple[bytes, int]:
    """Bits of a segment from its n-grams and their counts (rows may repeat), and the least
    level of those that they hold; at most 1 if they hold all.

    With fewer than ``segment_bits`` the rarest levels are left out whole.
    """
    sub, counts = summed(sub, counts)
    levels = level(counts)
    room = bits / BITS_PER_ENTRY
    by_level = np.bincount(levels, minlength=2)
    needed = np.cumsum((by_level * np.arange(len(by_level)))[::-1])[::-1]
    least = int(np.argmax(needed <= room)) if (needed <= room).any() else len(by_level)
    sub, levels = sub[levels >= least], levels[levels >= least]
    held = np.zeros(bits, np.uint8)
    for at in range(1, int(levels.max(initial=0)) + 1):
        for place in _bit_places(sub[levels >= at], at, bits):
            held[place] = 1
    return np.packbits(held).tobytes(), least


def split_key(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment (high bits) and 32-bit number within it of n-gram keys."""
    shift = np.uint64(65 - int(segments).bit_length())
    return (keys >> shift).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def probe(keys: np.ndarray, table: np.ndarray, segments: int) -> np.ndarray:
    """Levels of n-grams: probes of ever higher levels until one is missing."""
    bits = len(table) * 8 // segments
    segment, sub = split_key(keys, segments)
    return _probe_at(segment * bits, sub, table, bits)


def _probe_at(start: np.ndarray, sub: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Levels of n-grams whose segments start at these bits of the table."""
    out = np.zeros(len(sub), np.int64)
    alive, at = np.arange(len(sub)), 0
    while len(alive):
        at += 1
        offset = start[alive]
        hit = np.ones(len(alive), bool)
        for place in _bit_places(sub[alive], at, bits):
            where = offset + place.astype(np.int64)
            hit &= ((table[where >> 3] << (where & 7).astype(np.uint8)) & 128) > 0
        alive = alive[hit]
        out[alive] = at
    return out


def _training_rows(docs: DataFrame, trains_on: Column) -> DataFrame:
    return docs.filter(trains_on).select("text")


def word_counts(docs: DataFrame, trains_on: Column) -> DataFrame:
    """``key`` and exact count ``c`` of every training token."""

    def batch_of(found):
        keys, counts = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "c"]
        )

    def rows(batches):
        found, held = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                own = counted(token_rows(batch.slice(i, SLICE).column("text").to_pylist())[0])
                found.append(own)
                held += len(own[0])
                if held >= CHUNK:
                    yield batch_of(found)
                    found, held = [], 0
        if held:
            yield batch_of(found)

    parts = _training_rows(docs, trains_on).mapInArrow(rows, "key long, c long")
    return parts.groupBy("key").agg(F.sum("c").alias("c"))


def segments_for(n: int, filter_bits: int = FILTER_BITS) -> int:
    """Segments, a power of two, for ``n`` training tokens.

    A level never exceeds its count, so words and pairs make at most 2n level entries.
    """
    by_bits = 2 * n * BITS_PER_ENTRY // filter_bits
    return 1 << int(max(LEAST_SEGMENTS, n // TOKENS_PER_SEGMENT, by_bits) - 1).bit_length()


def _part_tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``token_rows`` of a part's texts."""
    texts = table.column("text")
    found = [
        token_rows(texts.slice(i, SLICE).to_pylist()) for i in range(0, table.num_rows, SLICE)
    ]
    tokens, before, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
    return tokens, before, sizes


def _by_segment(keys: np.ndarray, segments: int):
    """32-bit numbers of ascending keys, and (segment, begin, end) of each segment's."""
    segment, sub = split_key(keys, segments)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])[: len(segment)])
    ends = np.append(first[1:], len(sub))[: len(first)]
    return sub, list(zip(segment[first].tolist(), first.tolist(), ends.tolist(), strict=True))


def segment_table(docs: DataFrame, trains_on: Column, segments: int, top_bits: int) -> DataFrame:
    """``segment``, ``bits`` (of all its n-grams), ``top`` (of ``top_bits`` bits) and
    ``least``, the level from which on ``top`` holds all."""

    def rows(batches):
        found, held = [], 0

        def batch_of():
            keys, counts = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
            sub, spans = _by_segment(keys, segments)
            counts = counts.astype(np.uint32)
            columns = [
                pa.array([segment for segment, _, _ in spans], pa.int64()),
                pa.array([sub[a:b].tobytes() for _, a, b in spans], pa.binary()),
                pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["segment", "sub", "n"])

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                texts = batch.slice(i, SLICE).column("text").to_pylist()
                tokens, before, _ = token_rows(texts)
                own = counted(np.concatenate([tokens, pair_keys(before, tokens)]))
                found.append(own)
                held += len(own[0])
                if held >= CHUNK:
                    yield batch_of()
                    found, held = [], 0
        if held:
            yield batch_of()

    def build(table: pa.Table) -> pa.Table:
        sub = np.frombuffer(b"".join(table.column("sub").to_pylist()), np.uint32)
        counts = np.frombuffer(b"".join(table.column("n").to_pylist()), np.uint32)
        sub, counts = summed(sub, counts.astype(np.int64))
        bits, _ = build_segment(sub, counts, segment_bits(counts))
        top, least = build_segment(sub, counts, top_bits)
        return pa.table(
            {
                "segment": table.column("segment")[:1],
                "bits": pa.array([bits], pa.binary()),
                "top": pa.array([top], pa.binary()),
                "least": pa.array([least], pa.int64()),
            }
        )

    parts = _training_rows(docs, trains_on).mapInArrow(rows, "segment long, sub binary, n binary")
    return parts.groupBy("segment").applyInArrow(
        build, "segment long, bits binary, top binary, least long"
    )


def frequent_words(counts: DataFrame, most: int = EXACT_WORDS) -> tuple[int, np.ndarray, np.ndarray]:
    """The least count such that at most ``most`` words have it or more; these words'
    keys, ascending, and counts."""
    per_power = (
        counts.groupBy(F.floor(F.log2("c") * 8).alias("power"))
        .agg(F.count("*").alias("n"), F.min("c").alias("least"))
        .orderBy(F.desc("power"))
        .collect()
    )
    least, held = 1 << 62, 0
    for row in per_power:  # a few hundred steps of the logarithm
        held += row["n"]
        if held > most:
            break
        least = row["least"]
    rows = counts.filter(F.col("c") >= least).toPandas()
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return least, keys[order], rows["c"].to_numpy(np.int64)[order]


@dataclass(frozen=True)
class Model:
    """What training leaves: tables of exact word counts and of filter segments, and the
    small parts of both that are broadcast."""

    counts: DataFrame
    n: int
    v: int
    least_count: int
    frequent: tuple[np.ndarray, np.ndarray]
    segments: int
    bits: DataFrame
    top: np.ndarray
    least: np.ndarray

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
        of any documents."""
        return _scored(docs, self)


def fit(
    docs: DataFrame,
    trains_on: Column,
    filter_bits: int = FILTER_BITS,
    top_bits: int = TOP_BITS,
) -> Model:
    """Model of the rows for which ``trains_on`` holds.

    A segment of the filter has ``filter_bits`` at most on average, the filter that is
    broadcast ``top_bits``, or 64 for each segment.
    """
    counts = stored(word_counts(docs, trains_on))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least_count, keys, exact = frequent_words(counts)
    segments = segments_for(n, filter_bits)
    share = max(64, top_bits // segments)
    table = stored(segment_table(docs, trains_on, segments, share))
    top, least = np.zeros((segments, share // 8), np.uint8), np.zeros(segments, np.uint8)
    # The broadcast filter itself, of bounded size.
    for row in table.select("segment", "top", "least").toLocalIterator():
        top[row.segment] = np.frombuffer(row.top, np.uint8)
        least[row.segment] = row.least
    bits = table.select("segment", "bits")
    return Model(counts, n, v, least_count, (keys, exact), segments, bits, top.ravel(), least)


def score(
    docs: DataFrame, trains_on: Column, filter_bits: int = FILTER_BITS, top_bits: int = TOP_BITS
) -> DataFrame:
    """``Model.score`` of all documents by a model of those on which ``trains_on`` holds."""
    return fit(docs.select("doc_id", "text"), trains_on, filter_bits, top_bits).score(docs)


def _in_doubt(keys: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Levels of n-grams by the broadcast filter, and which of them it can't be sure of."""
    levels = probe(keys, tables["top"], tables["segments"])
    least = tables["least"][split_key(keys, tables["segments"])[0]]
    return levels, (least > 1) & (levels < least)


def part_levels(dealt: DataFrame, bits: DataFrame, shared) -> DataFrame:
    """``_part``, ``segment`` and ``levels`` (a byte each) of the part's distinct n-grams in
    doubt in that segment, ascending by key. ``dealt`` has ``_part`` and ``text``."""

    def grams(table: pa.Table) -> pa.Table:
        tokens, before, _ = _part_tokens(table)
        keys = distinct(np.concatenate([tokens, pair_keys(before, tokens)]))
        keys = keys[_in_doubt(keys, shared.value)[1]]
        sub, spans = _by_segment(keys, shared.value["segments"])
        return pa.table(
            {
                "_part": pa.array([table.column("_part")[0].as_py()] * len(spans), pa.int64()),
                "segment": pa.array([segment for segment, _, _ in spans], pa.int64()),
                "sub": pa.array([sub[a:b].tobytes() for _, a, b in spans], pa.binary()),
            }
        )

    def levels(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        bits = np.frombuffer(held.column("bits")[0].as_py() if held.num_rows else b"", np.uint8)
        for row in asked.column("sub"):
            sub = np.frombuffer(row.as_py(), np.uint32)
            found = np.zeros(len(sub), np.int64)
            if len(bits):
                found = _probe_at(found, sub, bits, 8 * len(bits))
            out.append(np.minimum(found, 255).astype(np.uint8).tobytes())
        return pa.table(
            {
                "_part": asked.column("_part"),
                "segment": asked.column("segment"),
                "levels": pa.array(out, pa.binary()),
            }
        )

    asked = dealt.groupBy("_part").applyInArrow(grams, "_part long, segment long, sub binary")
    return (
        asked.groupBy("segment")
        .cogroup(bits.groupBy("segment"))
        .applyInArrow(levels, "_part long, segment long, levels binary")
    )


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    n, v, least, counts = model.n, model.v, model.least_count, model.counts
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(model.frequent)
    shared = context.broadcast(
        {"top": model.top, "least": model.least, "segments": model.segments}
    )
    below = np.log10(n + v + 1.0)
    parts = max(LEAST_SEGMENTS, docs.count() // DOCS_PER_PART)
    # By input partition too, so that rows repeated very often do not meet in one part.
    salted = F.xxhash64("doc_id", "text", F.spark_partition_id())
    part = F.pmod(salted, F.lit(parts)).alias("_part")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", part)

    def model_scores(tokens, before, sizes, told):
        """Logarithms of the tokens' probabilities, with the levels told by segments."""
        keys, place = np.unique(
            np.concatenate([tokens, pair_keys(before, tokens)]), return_inverse=True
        )
        levels, doubt = _in_doubt(keys, shared.value)
        if doubt.sum() != len(told):
            raise ValueError(f"{len(told)} levels for {doubt.sum()} n-grams")
        levels[doubt] = told
        own = level_count(levels)
        count, both = own[place[: len(tokens)]], own[place[len(tokens) :]]
        first = np.empty_like(count)
        first[1:] = count[:-1]
        # No word comes before the start; there are as many starts as ends.
        first[np.cumsum(sizes) - sizes] = own[np.searchsorted(keys, END)]
        both = np.minimum(both, np.minimum(count, first))
        plain = (count + 1) / (n + v + 1.0)
        return np.log10((both + SMOOTHING * plain) / (first + SMOOTHING))

    def rows(texts: pa.Table, held: pa.Table) -> pa.Table:
        known, c = frequent.value
        tokens, before, sizes = _part_tokens(texts)
        levels = b"".join(held.sort_by("segment").column("levels").to_pylist())
        model = model_scores(tokens, before, sizes, np.frombuffer(levels, np.uint8))
        starts = np.cumsum(sizes) - sizes
        place = np.minimum(np.searchsorted(known, tokens), max(0, len(known) - 1))
        found = known[place] == tokens if len(known) else np.zeros(len(tokens), bool)
        count = np.where(found, c[place], 0) if len(known) else np.zeros(len(tokens))
        rest = ~found if least > 1 else np.zeros(len(tokens), bool)
        base = np.where(rest, 0.0, np.log10(count + 1) - below)
        upto = np.concatenate([[0], np.cumsum(np.add.reduceat(rest, starts))])
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_tokens": pa.array(sizes),
                "_known": pa.array(np.add.reduceat(found.astype(np.int64), starts)),
                "_base": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(np.add.reduceat(model, starts)),
                "_rest": pa.ListArray.from_arrays(
                    pa.array(upto, pa.int32()), pa.array(tokens[rest].view(np.int64))
                ),
            }
        )

    schema = "doc_id long, n_tokens long, _known long, _base double, score double, _rest array<long>"
    levels = part_levels(dealt, model.bits, shared)
    scored = dealt.groupBy("_part").cogroup(levels.groupBy("_part")).applyInArrow(rows, schema)
    out = ["doc_id", "n_tokens"]
    end = [F.lit(int(n)).alias("train_tokens"), F.col("_base").alias("base_score"), "score"]
    if least <= 1:  # every training word is among the frequent ones
        return scored.select(*out, F.col("_known").alias("n_known"), *end)
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()))
    rest = scored.select("_row", F.explode("_rest").alias("key")).groupBy("_row", "key").count()
    more = (
        rest.join(counts, "key", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("count")).otherwise(0)).alias("_more_known"),
            F.sum(
                F.col("count") * (F.log10(F.coalesce("c", F.lit(0)) + 1.0) - F.lit(float(below)))
            ).alias("_more_base"),
        )
    )
    whole = scored.join(more, "_row", "left").fillna(0, ["_more_known", "_more_base"])
    return whole.withColumns(
        {
            "_base": F.col("_base") + F.col("_more_base"),
            "n_known": F.col("_known") + F.col("_more_known"),
        }
    ).select(*out, "n_known", *end)
