"""The alphabet in which byte-level models spell a pre-token: a character for each byte of its UTF-8."""

from __future__ import annotations

_shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
_hidden = [x for x in range(256) if x not in _shown]
#: Bytes that print stand for themselves, the others for the characters from 256 on, in order.
_letters = {x: x for x in _shown} | {x: 256 + k for k, x in enumerate(_hidden)}


def spelled(piece: str) -> str:
    """What the model is given for one pre-token; ASCII letters stand for themselves."""
    return piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(_letters)
