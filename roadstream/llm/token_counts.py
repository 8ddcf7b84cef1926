"""Token counts without encoding, by a whole-token shortcut.

Merging each vocabulary string once on the driver proves which strings come out
as one token; ``alone`` in the tables says so. A pre-token that is such a string
counts as one; only the others are merged, and only for their number of tokens.

Rows: a null or empty text has 0 tokens. Other columns and repeated rows stay; the
output column replaces one of the same name. Texts are counted whole.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm import vocabulary as v
from roadstream.llm.bpe import broadcast_tables

SLICE = 256


def whole_tokens(tables: dict) -> frozenset[bytes]:
    """The vocabulary strings that encode alone as one token."""
    alone = tables["alone"]
    return frozenset(token for token, i in tables["ids"].items() if alone[i])


def count_tokens(texts: list[str | None], tables: dict) -> list[int]:
    """Number of tokens of each text."""
    known: dict[str, int] = v.kept(tables, "counts")
    whole = tables.get("whole") or tables.setdefault("whole", whole_tokens(tables))
    special = v.special_pattern(tables)
    parts = [[t] if special is None else special.split(t) for t in (t or "" for t in texts)]
    pieces = [[w for p in own[::2] for w in v.PIECES.findall(p)] for own in parts]
    rest = []
    for piece in set().union(*pieces).difference(known):
        if (raw := piece.encode()) in whole:
            known[piece] = 1
        else:
            rest.append((piece, raw))
    for (piece, _), tokens in zip(rest, v.merge_all([w for _, w in rest], tables), strict=True):
        known[piece] = len(tokens)
    # Every second part is a special string, one token.
    return [
        len(own) // 2 + sum([known[w] for w in cut])
        for own, cut in zip(parts, pieces, strict=True)
    ]


def token_count(text: Column | str, shared) -> Column:
    """Number of tokens of a text column."""

    @F.arrow_udf("long")
    def count_udf(texts: pa.Array) -> pa.Array:
        tables = shared.value
        done = []
        for i in range(0, len(texts), SLICE):
            done += count_tokens(texts.slice(i, SLICE).to_pylist(), tables)
        return pa.array(done, pa.int64())

    return count_udf(text)


def count(df: DataFrame, path: str, text: str = "text", output: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of ``text``."""
    return df.withColumn(output, token_count(text, broadcast_tables(df.sparkSession, path)))
