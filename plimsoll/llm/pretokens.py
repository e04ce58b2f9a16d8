"""Pre-tokens of byte-level tokenizers, found on the bytes of many texts at once.

A text may be cut wherever a pre-token begins that doesn't depend on what is left of it, so that nearly
all pieces are single pre-tokens. For counts at prefixes of a text the cut must also hold whatever is
right of it.
"""

from __future__ import annotations

import numpy as np

#: Kinds of bytes; 0 is controls and parts of wider characters.
LETTER, DIGIT, MARK, APOSTROPHE, SPACE, WHITE = range(1, 7)
BYTES = np.arange(256)
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = MARK
for _kind, _chars in ((DIGIT, b"0123456789"), (APOSTROPHE, b"'"), (SPACE, b" "), (WHITE, b"\t\n\x0b\x0c\r"),
                      (LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")):
    KINDS[list(_chars)] = _kind
#: Kinds left and right of a cut, as 8 * left + right: no pre-token holds both, but "'s" and the like.
MEET = np.zeros((8, 8), bool)
MEET[LETTER:SPACE, LETTER:] = ~np.eye(8, dtype=bool)[LETTER:SPACE, LETTER:]
MEET[MARK, APOSTROPHE] = MEET[APOSTROPHE, MARK] = MEET[APOSTROPHE, LETTER] = MEET[:, WHITE + 1] = False
MEET = MEET.ravel()
#: Bytes behind a space that surely begin no white space: the first bytes of wider white space are left out.
BEHIND = (BYTES > 0x20) & ~np.isin(BYTES, [0xC2, 0xE1, 0xE2, 0xE3])
#: Bytes ahead of a space that surely end no white space, of those that end wider characters.
AHEAD = (BYTES > 0x8F) & ~np.isin(BYTES, [0x9F, 0xA0, 0xA8, 0xA9, 0xAF])


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of a letter from U+00C0 to U+023F are one."""
    out = KINDS[data]
    at = np.nonzero((data >= 0xC3) & (data <= 0xC8))[0]
    at = at[(data[at] != 0xC3) | ((data[at + 1] & 0xDF) != 0x97)]  # times and division signs
    out[at] = out[at + 1] = LETTER
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, specials: list[str], prefixes: bool = False) -> np.ndarray:
    """Where pieces begin: at each text, ahead of white space, behind a line feed alone, and where letters, digits
    and marks meet. With `prefixes`, a run of white space stays whole: a prefix may end inside it."""
    kind, edge, cut = kinds(data), np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    cut[1:-1] = MEET[kind[:-1] * 8 + kind[1:]]
    # the last space before a character that is none goes with it, whatever is left of it
    at = np.nonzero((kind[:-1] == SPACE) & ~cut[:-2])[0]
    if prefixes:
        first = np.where(data[at - 2] >= 0xC0, data[at - 2], data[at - 3])  # of a wider character of 2 or 3 bytes
        at = at[AHEAD[data[at - 1]] | (data[at - 1] >= 0x80) & BEHIND[first]]
    cut[at[BEHIND[data[at + 1]] & ~edge[at + 1]]] = True
    # white space alone is a pre-token, a longer run depends on what is behind it
    at = np.nonzero(kind[1:-1] == WHITE)[0] + 1
    cut[at[MEET[kind[at - 1] * 8 + WHITE] & MEET[kind[at + 1] * 8 + WHITE]] + 1] = True
    held = data.tobytes()
    for special in map(str.encode, specials):
        at = held.find(special)
        while at >= 0:  # a run of white space ends here as it does at the end of a text
            cut[max(at - 1, 0):at] = cut[at + 1:at + len(special)] = False
            at = held.find(special, at + 1)
    cut |= edge
    return np.nonzero(cut[:-1])[0]


def plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which pieces are characters of one kind, with or without a space ahead: these are pre-tokens."""
    kind, starts = kinds(data), offsets[:-1]
    kind[kind == APOSTROPHE] = MARK
    spaced = kind[starts] == SPACE
    first = starts + spaced
    breaks = np.append(False, kind[1:] != kind[:-1])
    breaks[starts] = breaks[first[first < len(data)]] = False
    breaks |= (kind == 0) | (kind > MARK)
    breaks[starts[spaced]] = False
    sums = np.append(0, np.cumsum(breaks))
    return (sums[offsets[1:]] == sums[starts]) & (offsets[1:] > first)
