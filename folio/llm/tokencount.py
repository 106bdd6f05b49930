"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A byte-level BPE tokenizer first splits a text into pre-tokens, and encodes each by itself, so a text's count is the sum over its
pre-tokens. The tree's leaves are runs of pre-tokens, its inner nodes hold characters and tokens of their subtree. An edit descends to
where it begins, steps back to a pre-token boundary that the edit cannot influence, and splits anew from there until a new boundary meets
an old one behind the edit; only those pre-tokens are counted again, and only the sums above the leaves they stand in change.

Edge cases: a null text is empty and has no tokens. Edits are (start, end, text) in code points of the text as it was given, sorted and not
overlapping; an edit outside the text is cut to it, one that overlaps the edit before is left out, and null edits are none. An edit may be
an insertion or a deletion. A document of any length has one tree.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.llm.common import small_batches

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the public pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A pre-token's match looks at most so many characters beyond its end (after an apostrophe).
BEYOND = 3
LEAF = 64
MOST_KNOWN = 100_000


class Counts(dict):
    """Tokens of each pre-token seen; emptied when it grows too large."""

    def __init__(self, encoding: tiktoken.Encoding) -> None:
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> int:
        if len(self) >= MOST_KNOWN:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


@lru_cache(maxsize=2)
def counter(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[regex.Pattern, Counts]:
    """The splitting pattern and the counts, loaded once in each Python worker."""
    with open(f"{folder}/{vocabulary}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return regex.compile(PATTERN), Counts(tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))


class TokenTree:
    """Pre-tokens of one document: lengths and token counts in leaves, sums above."""

    def __init__(self, text: str, size: np.ndarray, count: np.ndarray, split: regex.Pattern, counts: Counts) -> None:
        self.text, self.split, self.counts, self.encoded = text, split, counts, 0
        self._plant(size, count)

    def _plant(self, size: np.ndarray, count: np.ndarray) -> None:
        leaves = max(1, -(-len(size) // LEAF))
        self.width = 1 << (leaves - 1).bit_length()
        self.leaves = [(size[i : i + LEAF].tolist(), count[i : i + LEAF].tolist()) for i in range(0, len(size), LEAF)] or [([], [])]
        self.leaves += [([], [])] * (self.width - len(self.leaves))
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for i, (s, c) in enumerate(self.leaves):
            self.sums[self.width + i] = sum(s), sum(c)
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at `place`, and the place its text begins at."""
        node, begin = 1, 0
        while node < self.width:
            left = int(self.sums[2 * node, 0])
            node *= 2
            if place >= begin + left and self.sums[node + 1, 0]:
                begin += left
                node += 1
        return node - self.width, begin

    def _set(self, leaf: int, size: list[int], count: list[int]) -> None:
        self.leaves[leaf] = (size, count)
        node = self.width + leaf
        self.sums[node] = sum(size), sum(count)
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces text[start:end]."""
        shift = len(new) - (end - start)
        old_size = len(self.text)
        self.text = self.text[:start] + new + self.text[end:]
        # back to a boundary whose pre-token before it did not look at the edit
        safe = max(0, start - BEYOND)
        leaf, begin = self._leaf_at(safe)
        sizes = self.leaves[leaf][0]
        keep, at = 0, begin
        while keep < len(sizes) and at + sizes[keep] <= safe:
            at += sizes[keep]
            keep += 1
        # old boundaries from there on, leaf by leaf, as new splits pass them
        last, used, old = leaf, keep, at
        size, count, place = [], [], at
        done = False
        while not done and place < len(self.text):
            m = self.split.match(self.text, place)
            piece = m.group()
            size.append(len(piece))
            count.append(self.counts[piece])
            place = m.end()
            while old + shift < place and old < old_size:  # the old boundary that this one might meet
                while used >= len(self.leaves[last][0]):
                    last, used = last + 1, 0
                old += self.leaves[last][0][used]
                used += 1
            done = old >= end and old + shift == place
        if not done:  # at the text's end: nothing of the old rest is left
            last, used = self.width - 1, len(self.leaves[-1][0])
        self.encoded += len(size)
        tail = self.leaves[last]
        size, count = self.leaves[leaf][0][:keep] + size + tail[0][used:], self.leaves[leaf][1][:keep] + count + tail[1][used:]
        for i in range(leaf + 1, last + 1):
            if self.leaves[i][0]:
                self._set(i, [], [])
        self._set(leaf, size, count)
        if len(size) > 8 * LEAF:  # a leaf that has grown too large: plant anew from what is counted
            self._plant(np.array([x for s, _ in self.leaves for x in s], np.int64), np.array([x for _, c in self.leaves for x in c], np.int64))


def planted(text: str, split: regex.Pattern, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and counts of a text's pre-tokens."""
    found = split.findall(text)
    return np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(map(counts.__getitem__, found), np.int64, len(found))


def packed(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs, behind a byte that says how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def trees(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """A document's tree to keep with it: struct<sizes, counts> of its pre-tokens, packed; sums are planted from them."""

    small_batches()
    @F.arrow_udf("sizes binary, counts binary")
    def build(texts: pa.Array) -> pa.Array:
        split, counts = counter(folder, vocabulary)
        made: list[list[bytes]] = [[], []]
        for t in texts:
            for out, values in zip(made, planted(t.as_py() or "", split, counts), strict=True):
                out.append(packed(values))
        return pa.StructArray.from_arrays([pa.array(x, pa.binary()) for x in made], ["sizes", "counts"])

    return build(text)


def edited(text: Column, tree: Column, edits: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, with_text: bool = True) -> Column:
    """Applies edits (array of struct<start int, end int, text string>) to texts with kept trees.

    struct<n_tokens, n_pretokens: before; n_edits; n_tokens_after; n_reencoded: pre-tokens counted anew; text_after>, the last only if it is asked for.
    """
    names = ["n_tokens", "n_pretokens", "n_edits", "n_tokens_after", "n_reencoded"]

    small_batches()
    @F.arrow_udf(", ".join(f"{n} long" for n in names) + (", text_after string" if with_text else ""))
    def apply(texts: pa.Array, kept: pa.Array, changes: pa.Array) -> pa.Array:
        split, counts = counter(folder, vocabulary)
        rows, after = [], []
        for t, k, e in zip(texts, kept, changes, strict=True):
            body, k = t.as_py() or "", k.as_py()
            sizes = unpacked(k["sizes"])
            tree = TokenTree(body, sizes, unpacked(k["counts"]), split, counts)
            before, pretokens, n, moved, done = tree.tokens, len(sizes), 0, 0, 0
            for x in e.as_py() or []:
                s, stop = min(max(x["start"], 0), len(body)), min(max(x["end"], x["start"], 0), len(body))
                if s >= done:
                    new = x["text"] or ""
                    tree.edit(s + moved, stop + moved, new)
                    moved, done, n = moved + len(new) - (stop - s), stop, n + 1
            rows.append((before, pretokens, n, tree.tokens, tree.encoded))
            if with_text:
                after.append(tree.text)
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
        return pa.StructArray.from_arrays([*columns, pa.array(after, pa.string())], [*names, "text_after"]) if with_text else pa.StructArray.from_arrays(columns, names)

    return apply(text, tree, edits)
