"""Word splitter of byte-level BPE as a deterministic transducer over character classes.

The splitting pattern has seven alternatives: contractions, words, numbers and
symbols with an optional space before them, and two forms of white space of
which one looks ahead.  Here it is a transducer of thirteen states; its look-ahead
is a delay: a transition may say that a word began at its own character or at the
one before.  A stream is cut into chunks of equal length.  All chunks are folded
at once into state maps (for each state at the start, the state at the end), the
maps are composed by a parallel prefix scan, and then every chunk is replayed from
its now known first state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from tokenizers.pre_tokenizers import ByteLevel

END, LETTER, SHORT, R, V, E, L, NUMBER, OTHER, QUOTE, SPACE, WHITE = range(12)
CLASSES = 12
(START, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE_1, WHITE_1, SPACE_N, WHITE_N, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CONTRACTED) = range(13)
STATES = 13
HERE, BEFORE = 1, 2  # a word began at this character; at the one before
UNKNOWN = 255
LETTERS = {LETTER, SHORT, R, V, E, L}


def _enter(c: int) -> int:
    """State of a word that begins with class c."""
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHER, QUOTE: QUOTED, SPACE: SPACE_1, WHITE: WHITE_1, END: START}.get(c, IN_LETTERS)


def _step(s: int, c: int) -> tuple[int, int]:
    joined = IN_LETTERS if c in LETTERS else IN_NUMBERS if c == NUMBER else IN_OTHER
    if s in (QUOTED_R, QUOTED_V, QUOTED_L):
        if c == (L if s == QUOTED_L else E):
            return CONTRACTED, 0
        to, flags = _step(IN_LETTERS, c)
        return to, flags | BEFORE
    if c == END:
        return START, HERE
    if s == IN_LETTERS and c in LETTERS or s == IN_NUMBERS and c == NUMBER or s == IN_OTHER and c in (OTHER, QUOTE):
        return s, 0
    if s in (SPACE_1, SPACE_N, WHITE_1, WHITE_N):
        if c in (SPACE, WHITE):
            return (SPACE_N if c == SPACE else WHITE_N), 0
        if s == SPACE_1:
            return joined, 0
        if s == SPACE_N:
            return joined, BEFORE
        return _enter(c), HERE | (BEFORE if s == WHITE_N else 0)
    if s == QUOTED:
        if c == SHORT:
            return CONTRACTED, 0
        if c in (R, V, L):
            return {R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[c], 0
        if c in (OTHER, QUOTE):
            return IN_OTHER, 0
    return _enter(c), HERE


NEXT = np.array([_step(s, c)[0] for s in range(STATES) for c in range(CLASSES)], np.int16)
FLAGS = np.array([_step(s, c)[1] for s in range(STATES) for c in range(CLASSES)], np.uint8)

_byte_level = ByteLevel(add_prefix_space=False, use_regex=True)
_classes = np.full(0x110000, UNKNOWN, np.uint8)


def _class_of(ch: str) -> int:
    fixed = {"'": QUOTE, " ": SPACE, "s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": R, "v": V, "e": E, "l": L}.get(ch)
    if fixed is not None:
        return fixed
    for probe, c in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):  # the library's own tables decide
        if len(_byte_level.pre_tokenize_str(probe + ch)) == 1:
            return c
    return WHITE


def classes(points: np.ndarray) -> np.ndarray:
    """Character classes of code points; unknown ones are asked of the library once per worker."""
    out = _classes[points]
    if (out == UNKNOWN).any():
        for p in np.unique(points[out == UNKNOWN]).tolist():
            _classes[p] = _class_of(chr(p))
        out = _classes[points]
    return out


def state_maps(cls: np.ndarray) -> np.ndarray:
    """cls: (length, chunks).  For each chunk, the state that each first state leads to."""
    maps = np.repeat(np.arange(STATES, dtype=np.int16)[:, None], cls.shape[1], 1)
    for row in cls:
        maps = NEXT.take(maps * CLASSES + row)
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive scan of the chunks' maps under composition, by doubling."""
    maps, width = maps.copy(), 1
    while width < maps.shape[1]:
        maps[:, width:] = np.take_along_axis(maps[:, width:], maps[:, :-width].astype(np.intp), 0)
        width *= 2
    return maps


def flags_of(cls: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Flags of every transition over the whole stream, which starts in START."""
    n = len(cls)
    chunks = max(1, -(-n // chunk))
    padded = np.zeros(chunks * chunk, np.int16)
    padded[:n] = cls
    rows = np.ascontiguousarray(padded.reshape(chunks, chunk).T)
    state = np.full(chunks, START, np.int16)
    if chunks > 1:
        state[1:] = prefix_scan(state_maps(rows))[START, :-1]
    flags = np.empty((chunk, chunks), np.uint8)
    for k, row in enumerate(rows):
        at = state * CLASSES + row
        flags[k] = FLAGS.take(at)
        state = NEXT.take(at)
    return np.ascontiguousarray(flags.T).reshape(-1)[:n]


class Words:
    """Words of many texts: byte positions in ``data`` and the text that each is of."""

    def __init__(self, texts: list[str], special: list[str] | None = None):
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        cls = classes(points)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        cls[ends] = END
        self.specials = np.zeros(len(texts), np.int64)
        if special:  # longest first: the library takes the longest of the leftmost
            find = re.compile("|".join(map(re.escape, special))).finditer
            for i, text in enumerate(texts):
                for m in find(text):
                    begin = int(ends[i]) - len(text)
                    cls[begin + m.start() : begin + m.end()] = END
                    self.specials[i] += 1
        flags = flags_of(cls)
        begins = (flags & HERE).astype(bool)
        begins[:-1] |= (flags[1:] & BEFORE).astype(bool)
        starts = np.flatnonzero(begins)
        real = cls[starts] != END
        stops = np.append(starts[1:], len(cls))[real]
        starts = starts[real]
        self.texts = len(texts)
        self.owner = np.searchsorted(ends, starts, "right")
        self.data = joined.encode()
        if len(self.data) == len(joined):
            self.starts, self.stops = starts, stops
        else:
            size = np.ones(len(points) + 1, np.int64)
            size[0] = 0
            size[1:] += (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            place = np.cumsum(size)
            self.starts, self.stops = place[starts], place[stops]


#: Between a sign or letter and a blank a word begins whatever stands around it, and no special string has a blank.
_SEAM = re.compile(r"(?<=[!-~])[ \n]")


def pieces(text: str, limit: int) -> Iterator[str]:
    """Consecutive pieces of about ``limit`` characters that are split into words as the whole text is; without a seam a piece goes on."""
    begin = 0
    while len(text) - begin > limit:
        seam = _SEAM.search(text, begin + limit)
        if seam is None:
            break
        yield text[begin : seam.start()]
        begin = seam.start()
    yield text[begin:] if begin else text


def packs(texts: list[str], limit: int) -> Iterator[tuple[list[str], list[int]]]:
    """The pieces of many texts, some ``limit`` characters at a time, and the text that each is of."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text, limit):
            if held and size + len(piece) > limit:
                yield held, owners
                held, owners, size = [], [], 0
            held.append(piece)
            owners.append(i)
            size += len(piece)
    if held:
        yield held, owners
