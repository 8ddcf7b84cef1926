"""Byte-level BPE vocabularies: tables, pre-tokens and exact merging.

Tables are plain dictionaries and arrays (a few MB, bounded by the vocabulary
file), read on the driver and broadcast, so that executors need no such file.
"""

import heapq
import json
import re

import numpy as np
import regex

# Fixed value: the white space of byte-level BPE.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(kind: str, below: int) -> str:
    """The characters of a Unicode property as ranges for a class of ``re``."""
    every = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)
    runs = (m[0] for m in regex.finditer(f"{kind}+", every))
    return "".join(r if len(r) == 1 else f"{r[0]}-{r[-1]}" for r in runs)


def pre_token_pattern() -> str:
    r"""Byte-level BPE's pattern of pre-tokens, for ``re``, which is faster than ``regex``:

    's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

    At any place at most one kind of alternative matches, so their order is free, but for
    the contractions. Classes of ``re`` are slow beyond U+FFFF: runs that neither hold nor
    meet such characters come first.
    """
    high = "\U00010000-\U0010ffff"
    few, numbers = _ranges(r"\p{L}", 0x10000), _ranges(r"\p{N}", 0x10000)
    all_letters, all_numbers = _ranges(r"\p{L}", 0x110000), _ranges(r"\p{N}", 0x110000)
    return "|".join(
        [
            f" ?[{few}]++(?![{high}])",
            "'(?:s|t|re|ve|m|ll|d)",
            f" ?[^{SPACE}{few}{numbers}{high}]++(?![{high}])",
            f" ?[{numbers}]++(?![{high}])",
            f"[{SPACE}]+(?![^{SPACE}])",
            f"[{SPACE.replace(' ', '')}]",
            f" ?[{all_letters}]+",
            f" ?[{all_numbers}]+",
            f" ?[^{SPACE}{all_letters}{all_numbers}]+",
            f"[{SPACE}]+",
        ]
    )


PIECES = re.compile(pre_token_pattern())

NO_RANK = 1 << 40
SHORT = 48  # bytes of words that are merged in a simple scan
END = 256  # stands for the end of a word among its bytes
KEPT = 400_000  # results of one kind a worker keeps, about 75 MB; then it starts anew


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_tables(path: str) -> dict:
    """Tables of a ``tokenizers`` JSON file that holds byte-level BPE.

    ``path`` is a file of the driver. Other kinds of tokenizer are refused.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    odd = [x for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")]
    plain_specials = not any(
        t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]
    )
    if (
        model["type"] != "BPE"
        or spec["normalizer"]
        or before.get("type") != "ByteLevel"
        or before["add_prefix_space"]
        or model.get("ignore_merges")
        or any(model.get(x) for x in odd)
        or not plain_specials
    ):
        raise ValueError(f"{path} is no plain byte-level BPE")
    alphabet = byte_alphabet()
    raw = {t: bytes(alphabet[c] for c in t) for t in model["vocab"]}
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*model["vocab"].values(), *specials.values()]) + 1
    token_bytes = [b""] * size
    for token, i in model["vocab"].items():
        token_bytes[i] = raw[token]
    for content, i in specials.items():
        token_bytes[i] = content.encode()
    ids = {raw[token]: i for token, i in model["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return merge_tables(ids, [(raw[a], raw[b]) for a, b in merges], token_bytes, specials)


def merge_tables(
    ids: dict[bytes, int],
    merges: list[tuple[bytes, bytes]],
    token_bytes: list[bytes],
    specials: dict[str, int],
) -> dict:
    """Lookup tables of a vocabulary and its merges in order of rank."""
    size = len(token_bytes)
    rank = np.full(size, -1, np.int64)
    left = np.full(size, -1, np.int64)
    right = np.full(size, -1, np.int64)
    pairs: dict[tuple[int, int], tuple[int, int]] = {}
    one_way = True
    for r, (a, b) in enumerate(merges):
        whole = ids[a + b]
        pairs[ids[a], ids[b]] = (r, whole)
        one_way &= rank[whole] == -1
        rank[whole], left[whole], right[whole] = r, ids[a], ids[b]
    keys = np.array([(a << 32) | b for a, b in pairs] or [-1], np.int64)
    ranks = np.array([r for r, _ in pairs.values()] or [NO_RANK], np.int64)
    order = np.argsort(keys)
    longest = [0] * 256
    for token in ids:
        longest[token[0]] = max(longest[token[0]], len(token))
    tables = {
        "ids": ids,
        "token_bytes": token_bytes,
        "specials": specials,
        "pairs": pairs,
        "pair_keys": keys[order],
        "pair_ranks": ranks[order],
        "pair_whole": np.array([w for _, w in pairs.values()] or [0], np.int64)[order],
        "rank": rank,
        "left": left,
        "right": right,
        "longest": longest,
        "byte_ids": [ids[bytes([b])] for b in range(256)],
        "one_way": one_way,
    }
    alone = np.zeros(size, bool)
    for token, i in ids.items():
        alone[i] = merge_exact(token, tables) == [i]
    return tables | {"alone": alone} | trie_tables(ids)


def trie_tables(ids: dict[bytes, int]) -> dict:
    """The vocabulary's strings as a trie in three arrays.

    The child of node n by byte b is cell ``base[n] + b``, if its ``parent`` is n; the
    ``token`` of a cell is -1 if no string ends there. Node 0 is the root. No node has a
    child by END, which stands after the last byte of a word.
    """
    prefixes = {t[:i] for t in ids for i in range(1, len(t) + 1)}
    children: dict[bytes, list[int]] = {}
    for p in sorted(prefixes):
        children.setdefault(p[:-1], []).append(p[-1])
    used, base, cells = bytearray(b"\1") + bytes(2 * END), {}, {b"": 0}
    last, cell = 0, 0

    def free(start: int) -> int:
        """The first free cell from ``start`` on, with room for every byte behind it."""
        at = used.find(0, start)
        if at + 2 * END > len(used):
            used.extend(bytes(len(used)))
        return at

    for p in sorted(children, key=lambda p: (-len(children[p]), p)):
        own = children[p]
        if len(own) != last:  # nodes of equally many children go to rising cells
            last, cell = len(own), 0
        cell = free(max(cell, own[0] + 1))
        while any(used[cell - own[0] + b] for b in own[1:]):
            cell = free(cell + 1)
        base[p] = cell - own[0]
        for b in own:
            used[base[p] + b] = 1
            cells[p + bytes([b])] = base[p] + b
    size = max(cells.values()) + END + 1
    arrays = {"base": np.zeros(size, np.int64)}
    arrays |= {"parent": np.full(size, -1), "token": np.full(size, -1)}
    for p, at in cells.items():
        arrays["base"][at] = base.get(p, 0)
        arrays["token"][at] = ids.get(p, -1)
        if p:
            arrays["parent"][at] = cells[p[:-1]]
    return arrays


def merge_exact(word: bytes, tables: dict) -> list[int]:
    """Token ids of a pre-token: the lowest rank merges first, leftmost on ties."""
    byte_ids, pairs = tables["byte_ids"], tables["pairs"]
    tokens = [byte_ids[b] for b in word]
    if len(tokens) > SHORT:
        return _merge_long(tokens, pairs)
    none = (NO_RANK, -1)
    found = [pairs.get(p, none) for p in zip(tokens, tokens[1:], strict=False)]
    while found:
        best = min(found)
        if best is none or best[0] == NO_RANK:
            break
        i = found.index(best)
        tokens[i : i + 2] = [best[1]]
        del found[i]
        if i > 0:
            found[i - 1] = pairs.get((tokens[i - 1], tokens[i]), none)
        if i < len(found):
            found[i] = pairs.get((tokens[i], tokens[i + 1]), none)
    return tokens


def _merge_long(tokens: list[int], pairs: dict) -> list[int]:
    """The same in n log n steps, with a heap over a linked list."""
    n = len(tokens)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (hit := pairs.get((tokens[i], tokens[j]))):
            heapq.heappush(heap, (hit[0], i, tokens[i], tokens[j], hit[1]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b, whole = heapq.heappop(heap)
        j = after[i]
        if tokens[i] != a or j >= n or tokens[j] != b:
            continue
        tokens[i], tokens[j] = whole, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [t for t in tokens if t >= 0]


def merge_all(words: list[bytes], tables: dict) -> list[list[int]]:
    """``merge_exact`` of many words, a merge of every word at a time."""
    out: list[list[int]] = [[]] * len(words)
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for i, w in enumerate(words):
        if len(w) > SHORT:
            out[i] = merge_exact(w, tables)
    raw = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
    tokens = np.array(tables["byte_ids"], np.int64)[raw]
    owner = np.repeat(np.array(short, np.int64), [len(words[i]) for i in short])
    keys, ranks, whole = tables["pair_keys"], tables["pair_ranks"], tables["pair_whole"]

    def looked_up(at: np.ndarray) -> np.ndarray:
        """Place in the pair tables of the tokens at ``at`` and after, or -1."""
        key = (tokens[at] << 32) | tokens[at + 1]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[place] == key) & (owner[at] == owner[at + 1]), place, -1)

    pair = np.full(len(tokens), -1, np.int64)
    pair[:-1] = looked_up(np.arange(len(tokens) - 1))
    while len(tokens):
        rank = np.where(pair >= 0, ranks[pair], NO_RANK)
        start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        least = np.minimum.reduceat(rank, start)
        size = np.diff(np.append(start, len(owner)))
        done = np.repeat(least == NO_RANK, size)
        if done.any():
            finished = np.flatnonzero(least == NO_RANK)
            values = tokens[done].tolist()
            upto = np.cumsum(size[finished]).tolist()
            for word, a, b in zip(
                owner[start[finished]].tolist(), [0, *upto], upto, strict=False
            ):
                out[word] = values[a:b]
            tokens, owner, pair, rank = (x[~done] for x in (tokens, owner, pair, rank))
            size, least = size[least < NO_RANK], least[least < NO_RANK]
            if not len(tokens):
                break
        hits = np.flatnonzero(rank == np.repeat(least, size))
        hits = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]
        tokens[hits] = whole[pair[hits]]
        keep = np.ones(len(tokens), bool)
        keep[hits + 1] = False
        tokens, owner, pair = tokens[keep], owner[keep], pair[keep]
        hits -= np.arange(len(hits))
        changed = np.concatenate([hits, hits[hits > 0] - 1])
        pair[changed[changed == len(tokens) - 1]] = -1
        changed = changed[changed < len(tokens) - 1]
        pair[changed] = looked_up(changed)
    return out


def special_pattern(tables: dict) -> re.Pattern | None:
    """Pattern that splits a text at special strings, the longest first."""
    names = sorted(tables["specials"], key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def kept(tables: dict, kind: str) -> dict:
    """What this worker keeps of one kind of result."""
    known = tables.setdefault(f"kept_{kind}", {})
    if len(known) > KEPT:
        known.clear()
    return known
