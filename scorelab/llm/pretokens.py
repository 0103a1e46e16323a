"""Vectorised pre-tokenisation: codepoint classes and an associative scan of transition functions.

The rule is the public byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Each character becomes a symbol (its class plus what it must know of the next
two characters); a symbol is a function on eight states. The functions reached
by composition form a small finite monoid, so that composing is one look-up in
a table and prefix states come from a blocked associative scan.
"""

from __future__ import annotations

import zlib

import numpy as np

LETTER, NUMBER, OTHER, WHITE = 0, 1, 2, 3
# Symbols: classes L N O, a space before a non-space, the last other white space
# before a non-space, other white space, an apostrophe before one-letter and
# two-letter endings.
S_L, S_N, S_O, S_SPACE, S_LAST, S_WHITE, S_ONE, S_TWO = range(8)
# States: nothing open, letters, numbers, others, a space that the next run
# takes, white space, and an ending that lacks one or two letters.
Q_NONE, Q_L, Q_N, Q_O, Q_SPACE, Q_WHITE, Q_ONE, Q_TWO = range(8)


def _next_state(q: int, s: int) -> tuple[int, bool]:
    """State after symbol ``s`` in state ``q``, and whether a token starts at it."""
    if s == S_L and q in (Q_ONE, Q_TWO):
        return (Q_NONE if q == Q_ONE else Q_ONE), False
    if s == S_L:
        return Q_L, q not in (Q_L, Q_SPACE)
    if s == S_N:
        return Q_N, q not in (Q_N, Q_SPACE)
    if s in (S_ONE, S_TWO) and q not in (Q_O, Q_SPACE):
        return (Q_ONE if s == S_ONE else Q_TWO), True
    if s in (S_O, S_ONE, S_TWO):
        return Q_O, q not in (Q_O, Q_SPACE)
    if s == S_SPACE:
        return Q_SPACE, True
    if s == S_LAST:
        return Q_NONE, True
    return Q_WHITE, q != Q_WHITE


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Functions by number, the composition table, generators (plain and after a reset), token starts."""
    step = np.array([[_next_state(q, s) for q in range(8)] for s in range(8)], dtype=np.int64)
    generators = [tuple(f) for f in step[:, :, 0]] + [(f[Q_NONE],) * 8 for f in step[:, :, 0].tolist()]
    number = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(int(g[x]) for x in f)
            if h not in number:
                number[h] = len(number)
                todo.append(h)
    made = list(number)
    table = np.zeros((16, 16), dtype=np.uint8)  # the monoid has 15 members
    for i, f in enumerate(made):
        table[i, : len(made)] = [number[tuple(int(g[x]) for x in f)] for g in made]
    return np.array(made, dtype=np.uint8), table.ravel(), np.array([number[tuple(map(int, g))] for g in generators], dtype=np.uint8), step[:, :, 1].astype(bool)


def _padded(values: np.ndarray) -> bytes:
    """A table of bytes for ``_look_up``."""
    return np.asarray(values, dtype=np.uint8).tobytes().ljust(256, b"\0")


def _look_up(table: bytes, x: np.ndarray) -> np.ndarray:
    """``table`` at every byte of ``x``; several times faster than numpy's take, which widens its indices."""
    return np.frombuffer(x.tobytes().translate(table), np.uint8).reshape(x.shape)


def _scan(x: np.ndarray, table: bytes, width: int = 64) -> np.ndarray:
    """Inclusive prefix compositions, left first: rows of ``width`` side by side, then the rows' totals."""
    n = len(x)
    if n <= width:
        out, acc = x.copy(), 0
        for i in range(n):
            acc = table[acc << 4 | int(x[i])]
            out[i] = acc
        return out
    rows = -(-n // width)
    padded = np.zeros(rows * width, dtype=np.uint8)
    padded[:n] = x
    cols = np.ascontiguousarray(padded.reshape(rows, width).T)
    for j in range(1, width):
        cols[j] = _look_up(table, (cols[j - 1] << 4) | cols[j])
    before = np.zeros(rows, dtype=np.uint8)
    before[1:] = _scan(cols[-1], table, width)[:-1]
    return np.ascontiguousarray(_look_up(table, (before << 4)[None, :] | cols).T).ravel()[:n]


class PreTokens:
    """Cuts texts into slices; ``classes`` has the class of every codepoint, zlib-packed."""

    def __init__(self, classes: bytes) -> None:
        self.classes = np.frombuffer(zlib.decompress(classes), dtype=np.uint8)
        self.ascii = _padded(self.classes[:128])
        made, table, self.generators, starts_at = _monoid()
        self.table, self.plain, self.after = _padded(table), _padded(self.generators), _padded(made[:, Q_NONE])
        self.starts_at = _padded(starts_at.ravel())

    def cut(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where slices start (the data's length at the end), and each text's first slice."""
        n = len(data)
        if not n:
            return np.zeros(1, np.int64), np.zeros(len(offs), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        b = data[lead] if len(lead) < n else data
        kind = _look_up(self.ascii, b).copy()
        multi = np.flatnonzero(b >= 0x80)
        if len(multi):
            pad = np.concatenate([data, np.zeros(4, np.uint8)])
            cp, p, c = np.zeros(len(multi), np.int32), lead[multi], b[multi]
            for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
                at = np.flatnonzero((c >= low) & (c < high))
                v = (c[at] & mask).astype(np.int32)
                for k in range(1, size):
                    v = (v << 6) | (pad[p[at] + k] & 0x3F)
                cp[at] = v
            kind[multi] = self.classes[cp]
        m = len(lead)
        first = np.searchsorted(lead, offs)  # of each text, among characters
        head = first[:-1][np.diff(offs) > 0]
        tail = np.append(head[1:], m) - 1
        then = np.full(m + 2, 4, np.uint8)  # class of the next character; 4 at a text's end
        then[: m - 1] = kind[1:]
        then[tail] = 4
        sym = kind.copy()
        white = kind == WHITE
        ends = white & (then[:m] < WHITE)
        sym[white] = S_WHITE
        sym[ends] = S_LAST
        sym[ends & (b == 32)] = S_SPACE
        quote = np.flatnonzero((b == 39) & (then[:m] == LETTER))
        if len(quote):
            more = np.concatenate([b, np.zeros(2, np.uint8)])
            a = more[quote + 1]
            c = np.where(then[quote + 1] == LETTER, more[quote + 2], 0)
            sym[quote[np.isin(a, [115, 116, 109, 100])]] = S_ONE
            two = ((a == 114) & (c == 101)) | ((a == 118) & (c == 101)) | ((a == 108) & (c == 108))
            sym[quote[two]] = S_TWO
        gen = _look_up(self.plain, sym).copy()
        gen[head] = self.generators[sym[head] + 8]
        state = _look_up(self.after, _scan(gen, self.table))
        prev = np.empty(m, np.uint8)
        prev[0] = Q_NONE
        prev[1:] = state[:-1]
        prev[head] = Q_NONE
        start = lead[_look_up(self.starts_at, (sym << 3) | prev).view(bool)]
        return np.append(start, n), np.searchsorted(start, offs)


def _pack(found: dict[int, np.ndarray]) -> bytes:
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, cps in found.items():
        classes[cps] = kind
    return zlib.compress(classes.tobytes())


_ALL = (range(0xD800), range(0xE000, 0x110000))


def classes_of_ranks() -> bytes:
    """Codepoint classes as the tiktoken library's own expressions see them (asked once, on the driver)."""
    import tiktoken

    every = "".join(chr(c) for r in _ALL for c in r)
    found = {}
    for kind, rule in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=rule, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        text = bytes(probe.encode_ordinary(every)).decode("utf-8")
        found[kind] = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return _pack(found)


def classes_of_json() -> bytes:
    """The same, as the tokenizers library's expressions see them."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    every = "".join(chr(c) for r in _ALL for c in r)
    found = {}
    for kind, rule in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        left = Split(Regex(rule), "removed").pre_tokenize_str(every)
        out = np.ones(len(every), dtype=bool)
        for _, (a, b) in left:
            out[a:b] = False
        at = np.flatnonzero(out)
        found[kind] = np.where(at < 0xD800, at, at + 0x800)
    return _pack(found)
