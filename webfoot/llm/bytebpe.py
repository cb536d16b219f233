"""Byte-level BPE helpers: cuts that no token spans, and a vocabulary's merges by a faster library."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import groupby

PART_CHARS = 1 << 16  # texts are encoded in parts of about this size

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The start of a run of blanks after such a letter or printable ASCII: no token of a byte-level vocabulary spans it.
CUT = re.compile(f"(?<=[!-~{LETTERS}])(?=[ \\n])")
#: Characters whose class (letter, number, blank, other) no two Unicode tables doubt: ASCII and the letters above, as UTF-8.
_ASCII = bytes([9, 10, 13, *range(32, 127)])
_LATIN = re.compile(rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*").fullmatch
#: The faster library's time grows with the square of a run's length.
_BLANKS = re.compile(r"\s{300}").search


def _plain(piece: str) -> bool:
    rest = piece.encode("utf-8", "replace").translate(None, _ASCII)
    return (not rest or _LATIN(rest) is not None) and max(map(len, piece.split()), default=0) < 300 and not _BLANKS(piece)


def parts(text: str) -> list[str]:
    """The text cut at places that no token spans, after ``PART_CHARS`` characters or more."""
    out, start = [], 0
    while len(text) - start > 2 * PART_CHARS:
        cut = CUT.search(text, start + PART_CHARS)
        if cut is None:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return out + [text[start:]]


def runs(part: str) -> Iterator[tuple[bool, str]]:
    """The part in pieces that no token spans, True where both libraries surely agree on the piece and it is cheap."""
    if _plain(part):
        yield True, part
        return
    for good, pieces in groupby(CUT.split(part), _plain):
        yield good, "".join(pieces)


def merges_of(held, special: list[str]) -> Callable[[str], list[int]] | None:
    """The tokenizer's merges by tiktoken, which is several times faster; None where ids do not follow the merges."""
    import public_tokenizers
    import tiktoken
    model = json.loads(held.to_str())["model"]
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    made = [ids.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in made or made != sorted(made) or len(ids) != len(made) + 256 or min(made) < 256:
        return None
    shown = [b for r in (range(33, 127), range(161, 173), range(174, 256)) for b in r]
    byte_of = {chr(b): b for b in shown}  # the byte-level alphabet: printable bytes stand for themselves,
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}  # the rest follow
    ranks = {bytes(byte_of[c] for c in t): i for t, i in ids.items()}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
