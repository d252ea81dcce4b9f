"""Packing documents into sequences along a space-filling curve.

A document's token ids are hashed into a count vector and projected to a few dimensions; its place on the Hilbert curve
through them is its sort key. Documents are range-sorted by it, so that neighbours on the curve, which are alike, share
sequences. The sorted ids are one stream, cut every ``size`` ids; running totals are taken within the sorted
partitions and joined by one total a partition. The stream's end is cut at powers of two, so nothing is padded.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, map_rows, ship, text_or_empty

#: The id that ends each document, and a sequence's size (fixed values of the contract).
END_ID, SIZE = 1, 2048
HASHED, DIMENSIONS, BITS = 256, 4, 15


@lru_cache(maxsize=1)
def _byte_alphabet() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as the code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Recent(dict):
    """A function's results by argument, ``limit`` at most: what was not asked for while half of them came in goes."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.half, self.older = function, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordCoder:
    """The ids of one word. A word of plain Latin letters goes straight to the tokenizer's merges, in lower case and in its byte
    alphabet; any other word goes through the whole tokenizer.
    """

    #: Letters that normalising only lower-cases, and marks that are a token run of their own.
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿŒœ]+)([.,;:!?|]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.tokenize = self.coder.model.tokenize
        self.letters = _byte_alphabet()
        # Blanks must be hard ends, and the short ways must give what the long one gives.
        probe = ["Word", "it's", "x.y", "1st"]
        if self.whole(" ".join(probe)) != b"".join(map(self.whole, probe)):
            raise ValueError("needs a vocabulary whose tokens end at blanks")
        some = ("Word", "été", "STRASSE", "größe", "Œuvre", "x" * 40)
        self.short = all(self.stem(w.lower()) == self.whole(w) for w in some)
        self.short &= all(self.whole(w + m) == self.whole(w) + self.whole(m) for w in ("Größe", "x.y", "3", "été") for m in (".", ",.", "?!|"))

    def whole(self, text: str) -> bytes:
        return _packed(self.coder.encode(text, add_special_tokens=False).ids)

    def stem(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.tokenize(shown)])

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return _packed([t.id for t in self.tokenize(word.lower())])
        if m := self.PLAIN.fullmatch(word):
            return self.stem(m[1].lower()) + (self.whole(m[2]) if m[2] else b"")
        return self.whole(word)


class WordIds:
    """Ids of whole texts from the ids of their words: for this kind of vocabulary no token reaches across a blank.

    Marks behind a Latin letter or digit are a token run of their own and become words. The coder doesn't know the memo, so
    that the memo goes as soon as its task has ended.
    """

    #: Marks at a word's end, where a Latin letter or digit stands before them.
    MARKS = re.compile(r"([.,;:!?|](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?|])[.,;:!?|]*)(?= )")

    def __init__(self, path: str, memo: int = 500_000):
        self.words = WordCoder(path)
        self.of_word = Recent(self.words.word if self.words.short else self.words.whole, memo)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        text = text.replace("\n", " ") + " "
        if self.words.short:
            text = self.MARKS.sub(r" \1", _lowered(text))
        return b"".join(map(self.of_word.__getitem__, text.split(" ")))


def _lowered(text: str) -> str:
    """A text of characters below U+0100 in lower case, in which each has one lower-case form of its own; others as they are."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


@lru_cache(maxsize=2)
def _projection(hashed: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((hashed, dimensions))


def project(ids: np.ndarray) -> np.ndarray:
    """A document's hashed count vector, logarithms of counts at unit length, in a few dimensions."""
    slots = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(HASHED)
    v = np.log1p(np.bincount(slots.astype(np.int64), minlength=HASHED))
    return (v / max(np.linalg.norm(v), 1e-9)) @ _projection(HASHED, DIMENSIONS)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2 ** bits, one row each (Skilling 2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tail_ends(total: int, size: int) -> list[int]:
    """Where sequences end in what whole sequences leave of a stream: at powers of two, the largest first."""
    at, ends = total - total % size, []
    for bit in range(size.bit_length(), -1, -1):
        if total % size >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def packed(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` ids: each id of each row's text lies in exactly one piece.

    Columns: the id, ``start`` (its document's ids before the piece), ``length``, ``ids_crc32`` (of the piece's ids as
    little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence) and
    ``curve_key``. All sequences are full but for the last few, whose lengths are powers of two.

    Null and empty texts are the end id alone. Each row is a document of its own, so null and repeated ids do no harm; equal
    curve keys are ordered by the rows' places. An empty table has no pieces. Other columns are ignored.
    """
    spark = docs.sparkSession

    def rows():
        words = WordIds(tokenizer_path)

        def apply(batch):
            places, sizes, kept = [], [], []
            for text in batch["text"]:
                ids = np.frombuffer(words.ids(text), dtype="<u4")
                places.append(project(ids))
                sizes.append(len(ids) + 1)
                kept.append(ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x00" + ids.tobytes())
            grid = np.clip((np.stack(places) / 12.0 + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
            return {"row": batch["row"], "id": batch["id"], "key": hilbert_keys(grid).tolist(), "n": sizes, "ids": kept}

        return apply

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    encoded = cut(map_rows(keyed, rows, "row long, id long, key long, n long, ids binary"), "encoded")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.full(len(n), part)), pa.array(ends - n), batch.column("n")], names=["row", "part", "before", "n"]
            )
            at = int(ends[-1]) if len(ends) else at

    ship(spark)
    ordered = encoded.select("row", "key", "n").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    ordered = cut(ordered.mapInArrow(running, "row long, part long, before long, n long"), "ordered")
    totals = {r.part: r.total for r in ordered.groupBy("part").agg(F.sum("n").alias("total")).collect()}  # one row a partition
    base, total = [], 0
    for part in sorted(totals):
        base.append((part, total))
        total += totals[part]
    ends = tail_ends(total, size)
    bases = F.broadcast(spark.createDataFrame(base, "part long, base long"))  # one row a partition too
    placed = ordered.join(bases, "part").select("row", (F.col("base") + F.col("before")).alias("at"))

    def cuts():
        whole = total - total % size
        tail_starts = np.array([whole, *ends[:-1]]) if ends else np.array([whole])

        def apply(batch):
            out = {k: [] for k in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "key")}
            for doc, key, n, raw, at in zip(batch["id"], batch["key"], batch["n"], batch["ids"], batch["at"], strict=True):
                ids = np.empty(n, dtype="<u4")
                ids[:-1] = np.frombuffer(raw, dtype="<u2") if len(raw) % 2 == 0 else np.frombuffer(raw[1:], dtype="<u4")
                ids[-1] = end_id
                view, start = memoryview(ids).cast("B"), 0
                while start < n:
                    place = at + start
                    if place < whole:
                        sequence, begin = divmod(place, size)
                        begin, stop = place - begin, place - begin + size
                    else:
                        k = int(np.searchsorted(tail_starts, place, side="right")) - 1
                        sequence, begin, stop = whole // size + k, int(tail_starts[k]), ends[k]
                    length = min(n - start, stop - place)
                    for k, v in zip(out, (doc, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), n, sequence, place - begin, key), strict=True):
                        out[k].append(v)
                    start += length
            return out

        return apply

    pieces = map_rows(
        encoded.join(placed, "row").select("id", "key", "n", "ids", "at"), cuts,
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, key long",
    )
    return pieces.withColumnsRenamed({"id": id_col, "key": "curve_key"})
