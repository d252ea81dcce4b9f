"""Token counts and subword coding against the library whose vocabulary they read."""

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, no_docs, odd_docs, some_texts

from kgspark.llm import pieces, tokens
from kgspark.llm.piece_model import BLANK, PieceModel, load

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"ab  in▁\n\té_.(²{$1 23ﬁ梦Ａ_", "the", "tion", " "]


@pytest.fixture(scope="module")
def unigram():
    """The same pieces read as a unigram vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as fields

    proto = fields.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = max(p.score, -40_000.0)  # small whole numbers add up exactly
    return PieceModel.of(proto)


def test_every_prefix_has_its_own_count():
    model = load(PATH)
    counter = tokens.PrefixCounter(model, memo=50, words=50)
    plain = [" ".join(x.split()) for x in some_texts(4, 300, PARTS)]
    for text in some_texts(3, 300, PARTS) + plain:
        want = [len(model.library.encode(text[:k])) for k in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == want
        assert counter.count(text) == want[-1]
        reach = [max(k for k in range(len(want)) if want[k] <= x) for x in (0, 1, 5, 7, 99)]
        assert tokens.cheapest_cuts(counter.prefixes(text), [0, 1, 5, 7, 99]) == reach
        assert counter.cuts(text, [0, 1, 5, 7, 99]) == (want[-1], reach)


def test_long_words_have_no_quadratic_cost():
    model = load(PATH)
    assert tokens.PrefixCounter(model).count(LONG) == len(model.library.encode(LONG))


def test_unigram_vocabularies_have_no_prefix_counts(unigram):
    with pytest.raises(ValueError):
        tokens.PrefixCounter(unigram)


def test_streaming_search_equals_the_library(unigram):
    for model in (load(PATH), unigram):
        decoder = pieces.Decoder(model)
        for text in some_texts(5, 300, PARTS, 60):
            search = pieces.StreamingViterbi(model)
            got = [*search.feed(model.normalised(text)), *search.finish()]
            assert got == (model.library.encode(text) if text else [])
            assert np.frombuffer(pieces.Coder(model, 20, 20).encode(text), dtype="<u4").tolist() == got
            assert decoder.decode(got) == text.replace(BLANK, " ")


def test_every_chunk_is_searched_in_the_window(monkeypatch):
    model, texts = load(PATH), some_texts(6, 100, PARTS, 60)
    monkeypatch.setattr(PieceModel, "last_pieces", lambda *_: pytest.fail("the search over whole prefixes"))
    coder = pieces.Coder(model, 20, 20)
    assert [np.frombuffer(coder.encode(x), dtype="<u4").tolist() for x in texts] == [model.library.encode(x) for x in texts]


def test_search_holds_a_bounded_window():
    model = load(PATH)
    search = pieces.StreamingViterbi(model)
    ids = [*search.feed(BLANK + "abcdefg" * 3000), *search.finish()]
    assert ids == model.library.encode("abcdefg" * 3000)
    assert search.largest <= 3 * model.longest


def test_odd_tables(spark):
    docs, library = odd_docs(spark), load(PATH).library
    text = {i: t or "" for i, t in docs.select("doc_id", "text").collect()}
    for r in tokens.token_counts(docs, PATH, [3, 4096], keep_prefixes=True).collect():
        if r.doc_id is not None:
            assert r.n_tokens == len(library.encode(text[r.doc_id])) == r.prefixes[-1] and r.n_bytes == len(text[r.doc_id].encode())
            assert r.prefixes[r.cuts[0]] <= 3
    back = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert len(back) == docs.count()
    assert all(r.text == text[r.doc_id].replace(BLANK, " ") for r in back if r.doc_id is not None)
    assert all(r.same for r in pieces.round_trip(docs, PATH).collect())
    for none in (tokens.token_counts(no_docs(spark), PATH, [1]), pieces.round_trip(no_docs(spark), PATH)):
        assert none.count() == 0
