"""Piece ids by the sentencepiece library, stretch by stretch.

A byte-pair model joins two neighbours only to a piece of its vocabulary. Where no piece goes from
another character to a space, nor over a line feed, nothing is ever joined from a character to a space
or a line feed after it, so the stretches between such places get the same ids as the whole text.
"""

from __future__ import annotations

import numpy as np
from sentencepiece import SentencePieceProcessor

#: How the vocabulary writes a space.
SPACE = "▁"
#: White space of one byte, by any library's reckoning.
WHITE = np.zeros(256, bool)
WHITE[[*range(9, 14), *range(28, 33)]] = True
#: Comes back as it was only from a model that folds no characters and keeps runs of spaces.
PROBE = "  ﬁ ①　x\t y\r\n z  "


def stretch_starts(data: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 text at which a space or line feed follows a character that is no white space."""
    at = np.flatnonzero((data[1:] == 32) | (data[1:] == 10)) + 1
    last = data[at - 1]
    certain = ~WHITE[last]
    wide = np.flatnonzero(last >= 128)  # the last byte of a wider character: white space lies in few blocks
    b1, b2, b3 = last[wide], data[at[wide] - 2], data[np.maximum(at[wide] - 3, 0)]
    certain[wide] = ~(((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 == 0xE1) & (b2 == 0x9A))
                      | ((b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81))) | ((b3 == 0xE3) & (b2 == 0x80)))
    return at[certain]


class PieceEncoder:
    """Texts to ids, each text behind the space that the model puts before it."""

    def __init__(self, path: str) -> None:
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = piece_bytes(self.model)
        pieces = [self.model.id_to_piece(k) for k in range(len(self.bytes))]
        back = b"".join(self.bytes[k] for k in self.model.encode(PROBE))
        #: whether stretches may be encoded one by one
        self.split = back == f" {PROBE}".encode() and not any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces)

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """Ids of stretches that begin with a space, which the library adds itself, or with a line feed."""
        found = self.model.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        for k, stretch in enumerate(stretches):
            if stretch == " ":  # the library gives an empty text no piece
                found[k] = [self.model.piece_to_id(SPACE)]
            elif stretch[0] == "\n":
                del found[k][0]
        return found


def piece_bytes(model: SentencePieceProcessor) -> list[bytes]:
    """Bytes that each piece stands for: its characters with spaces written out, or the one byte it names."""
    out = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace(SPACE, " ").encode())
    return out
