"""A SentencePiece BPE vocabulary as plain tables.

Spaces stand for the visible space mark inside this subpackage, so that a
literal mark in a text stays a character of its own.
"""

from __future__ import annotations

from functools import lru_cache

SPACE_MARK = "▁"


class PieceTable:
    """Pieces, scores and byte pieces of one model file.

    Raises ValueError for models this subpackage does not cover: another
    normaliser than identity, no byte fallback, pieces with a space after
    another character.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.text: list[str] = [""] * self.size
        self.byte_id: list[int] = [-1] * 256
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = piece.replace(SPACE_MARK, " ")
                self.text[i] = piece
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
        self.longest = max(map(len, self.ids))
        self.chars = {c for p in self.ids for c in p}
        self.bigrams = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        probe = "A éﬁＡ  b\t"
        if min(self.byte_id) < 0:
            raise ValueError("the model has no byte fallback")
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece has a space after another character")
        if not self.chars <= set(self.ids):
            raise ValueError("a piece has a character that is no piece")
        if sp.normalize(probe) != (" " + probe).replace(" ", SPACE_MARK):
            raise ValueError("the model's normaliser changes texts")


@lru_cache(maxsize=4)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)
