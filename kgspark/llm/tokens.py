"""Token counts by dynamic programming over prefixes.

For every prefix of a text one number is kept: how many tokens that prefix has on its own. The last token of
a prefix is the one piece that ends there, encodes to itself and may follow the last token before it; so a
prefix's count is that of a shorter prefix plus one. Questions about limits are then look-ups in the counts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from kgspark.llm.common import keyed_text, map_rows
from kgspark.llm.piece_model import BLANK, Memo, PieceModel, load


class PrefixCounter:
    """Prefix counts of whole texts, chunk by chunk: no piece reaches across a chunk's end, so counts add up."""

    def __init__(self, model: PieceModel, memo: int = 300_000, words: int = 800_000):
        if not model.merges:
            raise ValueError("prefix counts need a merge vocabulary; a unigram path has no single last token")
        self.model = model
        self.of_chunk = Memo(lambda chunk: tuple(model.last_pieces(chunk)[0]), memo)
        self.of_word = Memo(self._word, words)

    def _word(self, word: str) -> int:
        chunks = self.model.chunks.findall(BLANK + word)
        if len(chunks) == 1:
            return self.model.last_pieces(chunks[0])[0][-1]
        of = self.of_chunk
        if len(chunks[0]) > 1:  # the same word without what stands behind it
            return self.of_word[chunks[0][1:]] + sum([of[chunk][-1] for chunk in chunks[1:]])
        return sum([of[chunk][-1] for chunk in chunks])

    def count(self, text: str) -> int:
        if not text:
            return 0
        model = self.model
        if model.plain and model.dummy and "  " not in text and text[0] != " " and text[-1] != " " and BLANK not in text:
            return sum(map(self.of_word.__getitem__, text.split(" ")))
        of = self.of_chunk
        return sum([of[chunk][-1] for chunk in model.chunks.findall(model.normalised(text))])

    def cuts(self, text: str, limits: list[int]) -> tuple[int, list[int]]:
        """The text's tokens, and for each limit the code points of its longest prefix within it."""
        model = self.model
        if not text or not model.plain:
            n = self.count(text)
            return n, cheapest_cuts(self.prefixes(text), limits) if text else [0] * len(limits)
        if model.dummy and "  " not in text and text[0] != " " and text[-1] != " " and BLANK not in text:
            parts = text.split(" ")
            counts = list(map(self.of_word.__getitem__, parts))
            n = sum(counts)
            lengths = [1 + len(x) for x in parts] if any(n > x for x in limits) else []
            inside = self._prefixes_of_word
        else:
            parts = model.chunks.findall(model.normalised(text))
            counts = [self.of_chunk[x][-1] for x in parts]
            n = sum(counts)
            lengths = [len(x) for x in parts] if any(n > x for x in limits) else []
            inside = self.of_chunk.__getitem__
        if not lengths:
            return n, [len(text)] * len(limits)
        bases, at = [0, *accumulate(counts[:-1])], [0, *accumulate(lengths[:-1])]
        reach = [len(text) if n <= x else max(0, _furthest(bases, at, parts, x, inside) - model.dummy) if x >= 0 else 0 for x in limits]
        return n, reach

    def _prefixes_of_word(self, word: str) -> list[int]:
        out = [0]
        for chunk in self.model.chunks.findall(BLANK + word):
            base = out[-1]
            out.extend([base + n for n in self.of_chunk[chunk][1:]])
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Counts of the text's prefixes, by number of code points, from 0 on.

        Needs a vocabulary whose normalisation keeps one character for each; the empty prefix has no tokens.
        """
        if not self.model.plain:
            raise ValueError("prefix counts by code point need an identity normalisation")
        if not text:
            return np.zeros(1, dtype=np.int32)
        parts, base = [], 0
        for chunk in self.model.chunks.findall(self.model.normalised(text)):
            counts = np.array(self.of_chunk[chunk], dtype=np.int32)
            parts.append(counts[1:] + base)
            base += int(counts[-1])
        whole = np.concatenate(parts)
        out = np.concatenate(([0], whole[1:] if self.model.dummy else whole)).astype(np.int32)
        return out


def _furthest(bases: list[int], at: list[int], parts: list[str], limit: int, counts_of) -> int:
    """Normalised characters of the longest prefix within ``limit``: only the part that the limit falls in is looked into.

    ``bases`` are the tokens before each part; they grow, and every longer prefix has more than the part's base.
    """
    k = bisect_right(bases, limit) - 1
    inside = counts_of(parts[k])
    return at[k] + max(p for p, n in enumerate(inside) if bases[k] + n <= limit)


def longest_within(prefixes: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix that has at most ``limit`` tokens."""
    within = np.flatnonzero(prefixes <= limit)
    return int(within[-1]) if len(within) else 0


def cheapest_cuts(prefixes: np.ndarray, limits: list[int]) -> list[int]:
    """``longest_within`` for several limits, from one array of running minima."""
    least = np.minimum.accumulate(prefixes[::-1])[::-1]  # the fewest tokens of this prefix or any longer one
    return [bisect_left(least, limit + 1) - 1 if limit >= 0 else 0 for limit in limits]


def token_counts(docs: DataFrame, model_path: str, limits: list[int], id_col: str = "doc_id", text_col: str = "text", keep_prefixes: bool = False) -> DataFrame:
    """Exact token counts of whole texts, and how far each budget reaches.

    Returns a row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``cuts``, an array with, for each
    of ``limits``, the code points of the longest prefix of at most so many tokens; with ``keep_prefixes`` also
    ``prefixes``, the count at every prefix.

    Null and empty texts have no tokens and cuts of 0. Null ids and repeated rows are kept as they come. A very long
    text takes memory in proportion to its own length only. Other columns of ``docs`` are ignored.
    """

    def rows():
        counter = PrefixCounter(load(model_path))

        def one(text: str):
            if keep_prefixes or not counter.model.plain:
                counts = counter.prefixes(text)
                return int(counts[-1]), cheapest_cuts(counts, limits), counts.tolist()
            return *counter.cuts(text, limits), None

        def apply(batch):
            found = [one(x) for x in batch["text"]]
            out = {id_col: batch["id"], "n_bytes": [len(x.encode("utf-8", "surrogatepass")) for x in batch["text"]], "n_tokens": [x[0] for x in found], "cuts": [x[1] for x in found]}
            return out | ({"prefixes": [x[2] for x in found]} if keep_prefixes else {})

        return apply

    return map_rows(keyed_text(docs, id_col, text_col), rows, f"`{id_col}` long, n_bytes long, n_tokens long, cuts array<int>" + (", prefixes array<int>" if keep_prefixes else ""))
