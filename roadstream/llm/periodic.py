"""Runs of periodically repeated words, by an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are
the same) that no neighbouring word extends. All suffixes of a slice of texts are
sorted by prefix doubling, each text over words of its own, so that repeats are
found inside texts only. For an interval of suffixes with a common prefix of ``depth``
words, a suffix i and suffix i + depth that lie in different children of it start a
square of that period which cannot be moved to the right. It is enough to ask this,
by the inverse suffix array and in both directions, for the suffixes of all children
but the largest: O(n log n) questions. Each square found is moved to the left as far
as words agree, which gives the whole run; equal stretches keep the least period.
Everything is array operations over the slice; there is no tree.

Rows: a null or empty text has no words, no runs and an empty collapsed text. A very
long text makes a slice of its own, whose memory is a small multiple of its words
times the logarithm of its longest repeat. Repeated rows each get their result. Other
columns stay; the output column replaces one of the same name. An empty table stays
empty.
"""

from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm.store import small_batches

# Texts are worked on together up to this many words.
SLICE_WORDS = 200_000
RESULT = (
    "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def suffix_order(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes, and the rank of each place by its next 1, 2, 4, ... words.

    ``first`` numbers the words. Places of equal rank agree in so many words; the last
    ranks are all different and so are the inverse of the order. Only places whose
    rank is shared are sorted again.
    """
    order = np.argsort(first, kind="stable")
    known = first[order]
    opens = np.concatenate([[True], known[1:] != known[:-1]])
    places = np.arange(len(first))
    rank = np.empty(len(first), np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, places, 0))
    ranks, ahead = [rank], 1
    while True:
        shared = np.flatnonzero(~(opens & np.append(opens[1:], True)))
        if not shared.size:
            return order, ranks
        at = order[shared]
        key = rank[at] * len(first) + rank[at + ahead]
        by_key = np.argsort(key, kind="stable")
        at, key = at[by_key], key[by_key]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        order[shared], opens[shared] = at, fresh
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(fresh, shared, 0))
        ranks.append(rank)
        ahead *= 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each sorted suffix has in common with the one before it; -1 at both ends."""
    out = np.zeros(len(order) + 1, np.int64)
    out[0] = out[-1] = -1
    at = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    one, other = order[at - 1], order[at]
    begin = other.copy()
    for level in range(len(ranks) - 2, -1, -1):
        step = (ranks[level][one] == ranks[level][other]).astype(np.int64) << level
        one, other = one + step, other + step
    out[at] = other - begin
    return out


class _Nearest:
    """Nearest places on either side with a value below, or at most, a given one."""

    def __init__(self, values: np.ndarray, furthest: int):
        self.least = [values]
        while (1 << (len(self.least) - 1)) < furthest:
            last, width = self.least[-1], 1 << (len(self.least) - 1)
            wider = last.copy()
            np.minimum(last[:-width], last[width:], out=wider[:-width])
            self.least.append(wider)

    def after(self, at: np.ndarray, over: np.ndarray) -> np.ndarray:
        """First place after ``at`` whose value is not above ``over``."""
        at = at + 1
        for level in range(len(self.least) - 1, -1, -1):
            at = at + ((self.least[level][at] > over).astype(np.int64) << level)
        return at

    def before(self, at: np.ndarray, over: np.ndarray) -> np.ndarray:
        """Last place before ``at`` whose value is not above ``over``."""
        for level in range(len(self.least) - 1, -1, -1):
            width = 1 << level
            begin = np.maximum(at - width, 0)
            # The value at place 0 is below all, so a clipped stretch never passes.
            at = np.where(self.least[level][begin] > over, begin, at)
        return at - 1


def branching_squares(order, ranks, lcp, deepest) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of all squares that cannot be moved to the right.

    ``deepest`` is the longest period asked for at each sorted suffix.
    """
    inverse = ranks[-1]
    nothing = np.zeros(0, np.int64)
    cut = np.flatnonzero((lcp[:-1] > 0) & (lcp[:-1] <= deepest))
    if not cut.size:
        return nothing, nothing
    closed = np.flatnonzero(lcp < 1)
    near = _Nearest(lcp, int(np.diff(closed).max()))
    depth = lcp[cut]
    low, high = near.before(cut, depth - 1), near.after(cut, depth - 1)
    left, right = near.before(cut, depth), near.after(cut, depth)
    # The child right of each cut, and the one left of an interval's first cut.
    opens = left == low
    begin = np.concatenate([cut, low[opens]])
    end = np.concatenate([right, cut[opens]])
    depth, low, high = (np.concatenate([x, x[opens]]) for x in (depth, low, high))
    size = end - begin
    by_size = np.lexsort((size, high, low))
    last = np.append(
        (np.diff(low[by_size]) != 0) | (np.diff(high[by_size]) != 0), True
    )
    small = by_size[~last]
    size = size[small]
    of = np.repeat(small, size)
    within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    place = order[begin[of] + within]
    depth, low, high, begin, end = (x[of] for x in (depth, low, high, begin, end))

    def across(at, ok):
        there = inverse[np.where(ok, at, 0)]
        own = (there >= begin) & (there < end)
        return ok & (there >= low) & (there < high) & ~own

    ahead = across(place + depth, np.ones(len(place), bool))
    back = across(place - depth, place >= depth)
    starts = np.concatenate([place[ahead], (place - depth)[back]])
    periods = np.concatenate([depth[ahead], depth[back]])
    found = np.unique(np.stack([starts, periods], 1), axis=0)
    return found[:, 0], found[:, 1]


def runs_of(codes: np.ndarray, sizes: np.ndarray, least_length: int, least_exponent: int):
    """Runs of several texts given as word numbers, one text after the other.

    Returns (text, start, length, period) arrays, by text, start and period, of the runs
    of at least ``least_length`` words and ``least_exponent`` periods (2 at least).
    """
    n_texts = len(sizes)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    total = int(ends[-1]) if n_texts else 0
    text = np.repeat(np.arange(n_texts), sizes + 1)
    # Each text's words are its own, and each text ends in a word that no other place has.
    words = np.full(total, int(codes.max(initial=0)) + 1, np.int64)
    is_word = np.ones(total, bool)
    is_word[ends - 1] = False
    words[is_word] = codes
    width = int(words.max(initial=0)) + 1
    order, ranks = suffix_order(text * width + words)
    lcp = common_prefixes(order, ranks)
    deepest = (sizes // least_exponent)[text[order]]
    at, period = branching_squares(order, ranks, lcp, deepest)
    end = at + 2 * period
    for level in range(len(ranks) - 2, -1, -1):
        moved = at - (1 << level)
        ok = moved >= 0
        moved = np.where(ok, moved, 0)
        at = np.where(ok & (ranks[level][moved] == ranks[level][moved + period]), moved, at)
    length = end - at
    kept = length >= np.maximum(least_length, least_exponent * period)
    at, end, period = at[kept], end[kept], period[kept]
    by = np.lexsort((period, end, at))
    at, end, period = at[by], end[by], period[by]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (end[1:] != end[:-1])
    at, end, period = at[fresh], end[fresh], period[fresh]
    by = np.lexsort((period, at))
    at, end, period = at[by], end[by], period[by]
    own = text[at]
    return own, at - starts[own], end - at, period


def analyse(texts: list[str | None], least_length: int, least_exponent: int) -> list[tuple]:
    """(words, runs, collapsed text) of each text; a run is (start, length, period)."""
    split = [(t or "").encode().split() for t in texts]
    out = []
    begin = 0
    while begin < len(split):
        end, held = begin, 0
        while end < len(split) and (end == begin or held + len(split[end]) <= SLICE_WORDS):
            held += len(split[end])
            end += 1
        out += _slice(split[begin:end], least_length, least_exponent)
        begin = end
    return out


def _slice(split: list[list[bytes]], least_length: int, least_exponent: int) -> list[tuple]:
    number: dict[bytes, int] = {}
    codes = np.fromiter(
        (number.setdefault(w, len(number)) for w in chain.from_iterable(split)), np.int64
    )
    sizes = np.array([len(words) for words in split], np.int64)
    own, start, length, period = runs_of(codes, sizes, least_length, least_exponent)
    upto = np.searchsorted(own, np.arange(len(split) + 1))
    found = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    out = []
    for i, words in enumerate(split):
        runs = found[upto[i] : upto[i + 1]]
        kept = words
        if runs:
            change = np.zeros(len(words) + 1, np.int64)
            for s, n, q in runs:
                change[s + q] += 1
                change[s + n] -= 1
            kept = compress(words, np.cumsum(change[:-1]) == 0)
        out.append((len(words), runs, b" ".join(kept).decode()))
    return out


def periodic(text: Column | str, least_length: int = 6, least_exponent: int = 4) -> Column:
    """Struct of the number of words, the runs in order of start and period, and the
    text without the words that any run contains after its first period."""
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run has at least two periods and two words")

    @F.arrow_udf(RESULT)
    def runs_udf(texts: pa.Array) -> pa.Array:
        found = analyse(texts.to_pylist(), least_length, least_exponent)
        ends = np.cumsum([0] + [len(runs) for _, runs, _ in found]).astype(np.int32)
        flat = np.array([r for _, runs, _ in found for r in runs], np.int64).reshape(-1, 3)
        names = ["start", "length", "period"]
        runs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names)
        return pa.StructArray.from_arrays(
            [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), runs),
                pa.array([c for _, _, c in found], pa.string()),
            ],
            ["n_words", "runs", "collapsed"],
        )

    return runs_udf(text)


def with_runs(
    df: DataFrame,
    text: str = "text",
    output: str = "periodic",
    least_length: int = 6,
    least_exponent: int = 4,
) -> DataFrame:
    """Adds ``output``: n_words, runs and collapsed of each text."""
    small_batches(df.sparkSession)
    return df.withColumn(output, periodic(text, least_length, least_exponent))


def greatest(runs: Column | str) -> Column:
    """The run with the greatest exact length / period; ties go to the least start, then
    period. Null without runs."""
    column = F.col(runs) if isinstance(runs, str) else runs

    def better(best: Column, run: Column) -> Column:
        one, other = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (one > other), run).otherwise(best)

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.reduce(column, none, better)


def as_lines(runs: Column | str) -> Column:
    """Runs as text, one ``start,length,period`` and a line feed for each."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")


def repeated_tail(text: str | None, rest: int) -> str | None:
    """A text's words joined by one space, those from word a on replaced by its first p
    words from there, over and over: of n words a = rest % n and
    p = 1 + floor((n - a) / (3 + rest % 8)). A text without words stays."""
    words = (text or "").encode().split()
    if not words:
        return text
    begin = rest % len(words)
    tail = words[begin:]
    period = 1 + len(tail) // (3 + rest % 8)
    copies = -(-len(tail) // period)
    return b" ".join(words[:begin] + (tail[:period] * copies)[: len(tail)]).decode()
