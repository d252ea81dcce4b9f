"""A subword vocabulary as a lattice: which pieces may follow which, and where no piece can reach across.

The vocabulary, its scores and its normalisation are read from a SentencePiece file; segmentation is done here.
"""

from __future__ import annotations

import re
from functools import cached_property, lru_cache

#: The sign that stands for a blank inside pieces (fixed value of the file format).
BLANK = "▁"
#: Piece types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Memo(dict):
    """A function's results by argument; emptied when full, so that its size is bounded."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class PieceModel:
    """Pieces with ids and scores, and the exact rule for what a text's pieces are.

    For merge (BPE) vocabularies a sequence of pieces is the text's encoding exactly when every piece
    encodes to itself and every two neighbours encode to themselves, so one backpointer a prefix is enough.
    For unigram vocabularies the path of the highest score sum counts; of equal ones that with the longer last piece.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as fields

        proto = fields.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self._take(proto)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    @classmethod
    def of(cls, proto) -> PieceModel:
        """A model from an already parsed file, for tests with other settings."""
        import sentencepiece

        self = cls.__new__(cls)
        self._take(proto)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        return self

    def _take(self, proto) -> None:
        kinds = {p.type for p in proto.pieces}
        if kinds & {USER_DEFINED, UNUSED} or not proto.trainer_spec.byte_fallback or proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only merge or unigram vocabularies with byte fallback, without user-defined or unused pieces")
        self.merges = proto.trainer_spec.model_type == 2
        self.plain = proto.normalizer_spec.name == "identity" and not proto.normalizer_spec.remove_extra_whitespaces and proto.normalizer_spec.escape_whitespaces
        self.dummy = proto.normalizer_spec.add_dummy_prefix
        self.names = [p.piece for p in proto.pieces]
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_ids = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = min(self.scores.values(), default=0.0) - 10.0
        self.tails = {p[k:]: -1 for p in self.ids for k in range(len(p))} | self.ids
        self.follows = Memo(self._follows, 400_000)
        self.chunks = self._chunks()
        bare = type(proto)()
        bare.CopyFrom(proto)
        bare.normalizer_spec.add_dummy_prefix = False
        self._bare = bare.SerializeToString()

    def _chunks(self) -> re.Pattern:
        """A pattern that cuts a normalised text only where no piece of this vocabulary reaches across."""
        odd = ""
        coarse = rf"{BLANK}*[^{BLANK}]+|{BLANK}+"
        for _ in range(2):
            mark = rf"(?:[^\w{BLANK}\n]|[_{odd}])"
            fine = re.compile(rf"{BLANK}*(?:(?![{odd or '_'}])[^\W\d_])+|{BLANK}*{mark}+|{BLANK}*\d|{BLANK}+|\n")
            across = [p for p in self.ids if not fine.fullmatch(p)]
            if not across:
                return fine
            odd = "".join(sorted({c for p in across for c in p if not c.isalpha() and not c.isdecimal() and re.match(r"\w", c) and c != "_"}))
        if all(re.fullmatch(coarse, p) for p in self.ids):
            return re.compile(coarse)
        return re.compile(r"(?s).+")

    def normalised(self, text: str) -> str:
        if not text:
            return ""
        if not self.plain:
            return self.library.normalize(text)
        return (BLANK if self.dummy else "") + text.replace(" ", BLANK)

    @cached_property
    def pair_coder(self):
        """The library without its leading blank, to try single pieces and pairs of pieces."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self._bare)

    def _follows(self, key: int) -> bool:
        """Whether a piece may stand after another: key is (id before + 1) * pieces + id, with 0 for no piece before."""
        before, piece = divmod(key, len(self.names))
        if not before:
            return self.pair_coder.encode(self.names[piece]) == [piece]
        return self.pair_coder.encode(self.names[before - 1] + self.names[piece]) == [before - 1, piece]

    def last_pieces(self, chunk: str) -> tuple[list[int], list[int]]:
        """Of a merge vocabulary: each prefix's token count, and the id of its last token (-1: a character's bytes)."""
        tails, follows, n, size = self.tails, self.follows, len(chunk), len(self.names)
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(1, n + 1):
            for j in range(i - 1, -1, -1):
                piece = tails.get(chunk[j:i])
                if piece is None:  # no piece ends in this; so neither in anything longer
                    counts[i] = -1
                    break
                if piece >= 0 and follows[(last[j] + 1) * size + piece]:  # true of one piece only
                    counts[i], last[i] = counts[j] + 1, piece
                    break
            if counts[i] <= 0:  # outside the vocabulary: its bytes, which merge with nothing
                counts[i] = counts[i - 1] + len(chunk[i - 1].encode("utf-8", "surrogatepass"))
        return counts, last

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)
