"""Encoding and decoding with a subword vocabulary, by a Viterbi search that never holds a whole text's paths.

Only boundaries that a piece can still start from stay alive: as many as the longest piece has characters. As soon as
the backpointer paths of all of them run through one boundary, everything before it is settled and is handed out.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import keyed_text, map_rows
from kgspark.llm.piece_model import BLANK, Memo, PieceModel, load


class StreamingViterbi:
    """Feed characters; settled ids come out. At most the longest piece's boundaries, and what hangs on them, are held."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.held = ""  # what stands behind the settled boundary
        # Of each boundary from the settled one on: where its best path's last piece starts, that piece's id (-1: bytes), its score.
        self.start, self.piece, self.score = [0], [-1], [0.0]
        self.largest = 0  # boundaries held at most so far

    def feed(self, text: str) -> Iterator[int]:
        step, longest = self._merge_steps if self.model.merges else self._score_steps, self.model.longest
        for at in range(0, len(text), longest):
            if len(self.start) > longest:
                yield from self._settle()
            self.held += text[at : at + longest]
            step()
            self.largest = max(self.largest, len(self.start))

    def _merge_steps(self) -> None:
        text, start, piece = self.held, self.start, self.piece
        tails, follows, size = self.model.tails.get, self.model.follows, len(self.model.names)
        for end in range(len(start), len(text) + 1):
            best, found = end - 1, -1
            for j in range(end - 1, -1, -1):
                p = tails(text[j:end])
                if p is None:
                    break
                if p >= 0 and follows[(piece[j] + 1) * size + p]:
                    best, found = j, p
                    break
            start.append(best)
            piece.append(found)

    def _score_steps(self) -> None:
        model, text = self.model, self.held
        for end in range(len(self.start), len(text) + 1):
            best = None
            for j in range(max(0, end - model.longest), end):
                piece = model.ids.get(text[j:end])
                if piece is None and j < end - 1:
                    continue
                score = self.score[j] + (model.unknown_score if piece is None else model.scores[text[j:end]])
                if best is None or score > best[2]:
                    best = (j, -1 if piece is None else piece, score)
            for of, x in zip((self.start, self.piece, self.score), best, strict=True):
                of.append(x)

    def _settle(self) -> list[int]:
        """Hand out what all surviving paths share."""
        n = len(self.start)
        alive = set(range(max(0, n - self.model.longest), n))
        for far in range(n - 1, -1, -1):  # step the furthest boundary back until the paths meet
            if len(alive) == 1:
                break
            if far in alive:
                alive.remove(far)
                alive.add(self.start[far])
        return self._hand_out(alive.pop())

    def _hand_out(self, to: int) -> list[int]:
        start, piece, out, at = self.start, self.piece, [], to
        while at:
            out.extend((piece[at],) if piece[at] >= 0 else reversed(self.model.bytes_of(self.held[at - 1])))
            at = start[at]
        if to:
            self.held = self.held[to:]
            self.start, self.piece = [0, *[x - to for x in start[to + 1 :]]], piece[to:]
            if not self.model.merges:
                self.score = [x - self.score[to] for x in self.score[to:]]
        out.reverse()
        return out

    def finish(self) -> list[int]:
        return self._hand_out(len(self.start) - 1)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Coder:
    """Whole texts to ids and back. A chunk's end is a boundary that all paths share, so chunks repeat from memory."""

    def __init__(self, model: PieceModel, memo: int = 200_000, words: int = 500_000):
        self.model = model
        self.of_chunk = Memo(self._chunk, memo)
        self.of_word = Memo(self._word, words)

    def _word(self, word: str) -> bytes:
        chunks = self.model.chunks.findall(BLANK + word)
        if len(chunks) == 1:
            return self._chunk(chunks[0])
        if len(chunks[0]) > 1:  # the same word without what stands behind it
            return self.of_word[chunks[0][1:]] + b"".join(map(self.of_chunk.__getitem__, chunks[1:]))
        return b"".join(map(self.of_chunk.__getitem__, chunks))

    def _chunk(self, chunk: str) -> bytes:
        search = StreamingViterbi(self.model)
        return packed([*search.feed(chunk), *search.finish()])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        model = self.model
        if not text:
            return b""
        if model.plain and model.dummy and "  " not in text and text[0] != " " and text[-1] != " " and BLANK not in text:
            return b"".join(map(self.of_word.__getitem__, text.split(" ")))
        return b"".join(map(self.of_chunk.__getitem__, model.chunks.findall(model.normalised(text))))


class Decoder:
    """Ids to text: pieces joined, runs of byte pieces read as UTF-8, blanks restored, the leading blank dropped."""

    def __init__(self, model: PieceModel):
        self.model = model
        byte_of = {i: b for b, i in enumerate(model.byte_ids)}
        named = {i: p.replace(BLANK, " ") for p, i in model.ids.items()}
        self.parts = [bytes([byte_of[i]]) if i in byte_of else named.get(i, "").encode() for i in range(len(model.names))]

    def decode(self, ids) -> str:
        raw = b"".join(map(self.parts.__getitem__, ids))
        if self.model.dummy and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _id_lists(found: list[bytes]) -> pa.Array:
    values = np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32)
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The piece ids of whole texts: a row per input row, the id and ``ids`` (array<int>), without control pieces.

    Null and empty texts give empty arrays; null ids and repeated rows stay; other columns are ignored. Characters
    outside the vocabulary become their UTF-8 bytes. A text is searched with a bounded window, however long it is.
    """

    def rows():
        coder = Coder(load(model_path))
        return lambda batch: {id_col: batch["id"], "ids": _id_lists([coder.encode(x) for x in batch["text"]])}

    return map_rows(keyed_text(docs, id_col, text_col), rows, f"`{id_col}` long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts of ids: a row per input row, the id and ``text``; null ids decode to the empty text, bytes that
    are no UTF-8 to U+FFFD. The sign U+2581 stands for blanks inside pieces and comes back as a blank."""

    def rows():
        decoder = Decoder(load(model_path))
        return lambda batch: {id_col: batch["id"], "text": [decoder.decode(x or ()) for x in batch["ids"]]}

    return map_rows(encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")), rows, f"`{id_col}` long, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: the id, ``n_pieces``, ``ids_crc32`` (of little-endian unsigned 32-bit ids),
    ``n_chars`` decoded and ``same``, whether the text came back (U+2581 counts as a blank)."""

    def rows():
        coder, decoder = Coder(load(model_path)), Decoder(load(model_path))

        def apply(batch):
            ids = [coder.encode(x) for x in batch["text"]]
            back = [decoder.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in ids]
            return {
                id_col: batch["id"], "n_pieces": [len(x) // 4 for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids],
                "n_chars": [len(x) for x in back], "same": [a == b.replace(BLANK, " ") for a, b in zip(back, batch["text"], strict=True)],
            }

        return apply

    return map_rows(keyed_text(docs, id_col, text_col), rows, f"`{id_col}` long, n_pieces long, ids_crc32 long, n_chars long, same boolean")
