"""Finite automata over many bytes at once, by composition of chunk transitions.

A chunk of bytes acts on an automaton as a map from states to states. These maps are computed for all
chunks side by side, one byte position at a time, and composed by a parallel prefix scan, which gives
the state at each chunk's start whatever lies before it; a second pass then gives the state before
every byte. Records are separated by END, on which every state returns to the first.
"""

from __future__ import annotations

import numpy as np

#: 0xFF occurs in no UTF-8 text.
END = 0xFF
CHUNK = 256


class Automaton:
    """classes: byte to class (256). table: (state, class) to next state. State 0 is the start; an extra class keeps the state."""

    def __init__(self, states: int, classes: dict[int, list[int]], moves: dict[int, list[int]], ranges: tuple = ()):
        """classes: class number to its bytes (others are class 0); ranges: (class, first, last); moves: state to its next states by class; END is the last of these classes."""
        n = len(moves[0])
        self.classes = np.zeros(256, np.uint8)
        for k, first, last in ranges:
            self.classes[first : last + 1] = k
        for k, some in classes.items():
            self.classes[some] = k
        self.classes[END] = n - 1
        self.table = np.zeros((states, n + 1), np.uint8)
        for s, row in moves.items():
            self.table[s, :n] = row
            self.table[s, n] = s
        self.keep = n

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state before each byte."""
        n = len(data)
        if not n:
            return np.empty(0, np.uint8)
        chunks = -(-n // CHUNK)
        kinds = np.full(chunks * CHUNK, self.keep, np.uint8)
        kinds[:n] = self.classes[data]
        kinds = np.ascontiguousarray(kinds.reshape(chunks, CHUNK).T)
        acts = np.repeat(np.arange(len(self.table), dtype=np.uint8)[:, None], chunks, 1)
        for k in kinds:
            acts = self.table[acts, k]
        width = 1
        while width < chunks:  # acts[:, i] becomes the map of chunks 0..i
            acts[:, width:] = np.take_along_axis(acts[:, width:], acts[:, :-width], 0)
            width *= 2
        state = np.zeros(chunks, np.uint8)
        state[1:] = acts[0, :-1]
        out = np.empty((CHUNK, chunks), np.uint8)
        for i, k in enumerate(kinds):
            out[i] = state
            state = self.table[state, k]
        return out.T.reshape(-1)[:n]


COMMA, QUOTE, BACKSLASH = ord(","), ord('"'), ord("\\")
#: CSV. States: 0 start of a field, 1 plain, 2 quoted, 3 quote within quotes, 4 broken. Classes: other, comma, quote, END.
FIELD, PLAIN, QUOTED, CLOSED, BROKEN = range(5)
CSV = Automaton(
    5,
    {1: [COMMA], 2: [QUOTE]},
    {FIELD: [PLAIN, FIELD, QUOTED, 0], PLAIN: [PLAIN, FIELD, BROKEN, 0], QUOTED: [QUOTED, QUOTED, CLOSED, 0], CLOSED: [BROKEN, FIELD, QUOTED, 0], BROKEN: [BROKEN, BROKEN, BROKEN, 0]},
)
#: JSON strings. States: 0 outside, 1 in a string, 2 after a backslash, 3..6 hexadecimal digits due, 7 broken.
#: Classes: other, quote, backslash, simple escape (b f n r t /), u, hexadecimal, control, END. b and f are hexadecimal too.
OUTSIDE, STRING, ESCAPE, JSON_BROKEN = 0, 1, 2, 7
_B = 7
JSON = Automaton(
    8,
    {1: [QUOTE], 2: [BACKSLASH], 3: list(b"nrt/"), 4: list(b"u"), 5: list(b"0123456789ABCDEFacde"), 8: list(b"bf")},
    {
        0: [0, 1, _B, 0, 0, 0, 0, _B, 0, 0],
        1: [1, 0, 2, 1, 1, 1, _B, _B, 1, 0],
        2: [_B, 1, 1, 1, 3, _B, _B, _B, 1, 0],
        3: [_B, _B, _B, _B, _B, 4, _B, _B, 4, 0],
        4: [_B, _B, _B, _B, _B, 5, _B, _B, 5, 0],
        5: [_B, _B, _B, _B, _B, 6, _B, _B, 6, 0],
        6: [_B, _B, _B, _B, _B, 1, _B, _B, 1, 0],
        7: [_B] * 9 + [0],
    },
    ranges=((6, 0x00, 0x1F),),
)
# blanks that JSON allows between tokens are control characters within strings only
JSON.table[OUTSIDE, 6] = OUTSIDE


def join_records(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The records' bytes, each followed by END, with each record's first byte and its END."""
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    return data, ends - sizes, ends
