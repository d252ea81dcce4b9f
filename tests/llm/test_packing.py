"""Packing: every id once, sequences whole, neighbours together."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import no_docs, odd_docs, some_texts
from tokenizers import Tokenizer

from kgspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, size: int):
    """Hold the pieces against the library's ids."""
    coder = Tokenizer.from_file(PATH)
    pieces = packing.packed(docs, PATH, size=size).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append(p)
        by_sequence[p.sequence_id].append(p)
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = [*coder.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[r.doc_id, len(ids)].append(ids)
    assert set(want) == set(by_doc)
    for key, texts in want.items():
        if len(texts) == 1:
            at = 0
            for p in sorted(by_doc[key], key=lambda p: p.start):
                assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(texts[0][at : at + p.length], dtype="<u4").tobytes())
                at += p.length
        assert sum(p.length for p in by_doc[key]) == sum(map(len, texts))
    lengths = []
    for k in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[k], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        lengths.append(at)
    assert sorted(by_sequence) == list(range(len(lengths)))
    assert all(n <= size and n & (n - 1) == 0 for n in lengths), "full, or a power of two"
    return pieces


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 2048)


@pytest.mark.parametrize("size", [4, 2048])
def test_odd_tables(spark, size):
    check(odd_docs(spark), size)
    assert packing.packed(no_docs(spark), PATH).count() == 0


def test_ids_by_words():
    coder, words = Tokenizer.from_file(PATH), packing.WordIds(PATH, memo=100)
    texts = some_texts(21, 400, ["a", "É", " ", "\n", "\t", "\x1c", "\xa0", "'s", "1", ".", "<|endoftext|>", "<|startoftext|>", "ΑΣ", "Σ", "😀", "<|start", "oftext|>", "̈"])
    for text in texts:
        assert np.frombuffer(words.ids(text), dtype="<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


def test_the_short_way_is_the_long_way():
    coder, words = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    assert words.words.short
    texts = some_texts(22, 2000, [*"abcdeéèÉßÿŒœÀÑñäÄ.,;:!?|", "the", "tion", "SCH"], 12)
    for text in texts:
        assert np.frombuffer(words.ids(text), dtype="<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_steps_to_neighbours(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_tail():
    assert packing.tail_ends(2048 * 3 + 5, 2048) == [2048 * 3 + 4, 2048 * 3 + 5] and packing.tail_ends(4096, 2048) == []
