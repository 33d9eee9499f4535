"""Vocabulary of a SentencePiece model file and the words its pieces stay in.

No piece of such a vocabulary runs from text into a blank mark, or holds a line
end, so a text may be segmented word by word: a word is a run of blanks with the
text after it. The first word of a text gets the model's leading blank.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

MARK = "▁"
_WORDS = re.compile(r" *[^ ]+| +")


class Pieces:
    """Pieces of a model file: ids, scores, bytes."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        # in texts a blank stands for the mark; the mark itself is spelt in bytes
        self.ids = {model.id_to_piece(i).replace(MARK, " "): i for i in plain}
        self.scores = np.array([model.get_score(i) for i in range(n)])
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.spelt = [b""] * n
        for piece, i in self.ids.items():
            self.spelt[i] = piece.encode()
        for b, i in enumerate(self.byte):
            self.spelt[i] = bytes([b])
        self.longest = max(map(len, self.ids))
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.ids):
            raise ValueError("a piece runs over the end of a word")

    @staticmethod
    @cache
    def of(path: str) -> "Pieces":
        return Pieces(path)

    def char_ids(self, char: str) -> list[int]:
        """A character by itself: its piece, or its bytes."""
        i = self.ids.get(char)
        return [i] if i is not None else [self.byte[b] for b in char.encode("utf-8", "surrogatepass")]

    def text(self, ids: list[int]) -> str:
        """The text that was encoded; the leading blank of the model goes."""
        out = b"".join(map(self.spelt.__getitem__, ids)).decode("utf-8", "surrogatepass")
        return out[1:] if out.startswith(" ") else out


def words(text: str) -> list[str]:
    out: list[str] = []
    if not text:
        return out
    for n, line in enumerate((" " + text).split("\n")):
        if n:
            out.append("\n")
        if "  " in line or line[-1:] == " ":
            out += _WORDS.findall(line)
        elif line:
            head, *rest = line.split(" ")
            if head:
                out.append(head)
            out += [" " + w for w in rest]
    return out
