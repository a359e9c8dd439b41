"""The pieces of a SentencePiece model file, read once in each Python process."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

#: The sign that stands for a space, and the name of a byte piece.
SPACE = "▁"
BYTE_NAME = "<0x%02X>"


@dataclass
class Vocabulary:
    ids: dict[str, int]  # pieces that text can be cut into
    ranks: dict[str, int]  # place in merging order: the score, highest first; equal scores share a place
    bytes_: list[int]  # ids of the 256 byte pieces
    unknown: int


def model_path(model: str) -> str:
    """A path as it is; a bare name is a file of the installed public vocabularies."""
    if os.path.dirname(model):
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


@lru_cache(maxsize=4)
def vocabulary(model: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
    n = sp.vocab_size()
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = {sp.id_to_piece(i): i for i in normal}
    if any(a != SPACE and b == SPACE for p in pieces for a, b in zip(p, p[1:])):
        raise ValueError("a piece holds a space after another character; words of this model can't be cut apart")
    scores = sorted({sp.get_score(i) for i in normal}, reverse=True)
    place = {s: r for r, s in enumerate(scores)}
    return Vocabulary(pieces, {p: place[sp.get_score(i)] for p, i in pieces.items()}, [sp.piece_to_id(BYTE_NAME % b) for b in range(256)], sp.unk_id())
