"""Byte-pair encoding as a left-to-right lattice.

For a merge list the encoding of a prefix extended by one symbol follows from the
encodings of the shorter prefixes: exactly one vocabulary token that ends there may
follow the last token of the prefix before it, and it may do so if merging the two
tokens' symbols gives the two tokens back. That makes an encoder that needs only a
window of the longest token's length, with one backpointer per position.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

Symbols = bytes | str


def edges_while_merging(token: Symbols, rank: Callable) -> tuple[list, list] | None:
    """What stands at the token's two ends while its symbols are merged.

    Merging takes the best-ranked adjacent pair first, the leftmost of equals. For
    the right and for the left end: the symbols standing there in turn, each with
    the rank of the merge that takes it up, the whole token last. None if the
    symbols do not merge to the token.
    """
    parts = [token[i : i + 1] for i in range(len(token))]
    right, left = [], []
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = rank((parts[i], parts[i + 1]))
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return None
        if at == 0:
            left.append((parts[0], best))
        if at == len(parts) - 2:
            right.append((parts[-1], best))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [*right, (token, NEVER)], [*left, (token, NEVER)]


NEVER = float("inf")


class Lattice:
    """Tokens, their proper prefixes, and which token may follow which."""

    def __init__(self, tokens: Iterable[Symbols], rank: Callable):
        self.rank = rank
        self.tokens = set(tokens)
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.longest = max(map(len, self.tokens), default=1)
        self._ends: dict[Symbols | None, tuple | None] = {None: ([(None, NEVER)], [(None, NEVER)])}

    def _end(self, token: Symbols | None) -> tuple | None:
        if token in self._ends:
            return self._ends[token]
        ends = self._ends[token] = edges_while_merging(token, self.rank)
        return ends

    def follows(self, left: Symbols | None, right: Symbols) -> bool:
        """Whether ``right`` may come after ``left`` (None: at the beginning).

        It may unless a merge across the border comes before the merges that take
        up the symbols on its two sides; of equal ranks the left one comes first.
        """
        after, before = self._end(right), self._end(left)
        if after is None or before is None:
            return False
        ends, starts, i, j, rank = before[0], after[1], 0, 0, self.rank
        while True:
            (x, up_x), (y, up_y) = ends[i], starts[j]
            across = rank((x, y))
            if across is not None and across < up_x and across <= up_y:
                return False
            if up_x <= up_y:
                if up_x == NEVER:
                    return True
                i += 1
            else:
                j += 1


BYTES = [bytes([b]) for b in range(256)]
START = ((b"", None, 0),)  # the state before a word


class CountTransducer:
    """Deterministic transducer over bytes: transitions carry the change of the token count.

    A state holds, for every suffix that a longer token could still begin with, the
    last token before it and the token count up to it relative to the present one.
    Prefixes with equal futures share a state. Transitions are compiled when first
    taken and kept; ``most`` bounds the states, beyond it compiling starts anew.
    """

    def __init__(self, lattice: Lattice, most: int = 300_000):
        self.lattice, self.most = lattice, most
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = [START]
        self.number: dict[tuple, int] = {START: 0}
        # (state, byte) in one integer to (next state, change + 128) in one integer
        self.steps: dict[int, int] = {}

    def _compile(self, state: int, byte: int) -> int:
        lattice, symbol, delta = self.lattice, BYTES[byte], None
        tokens, prefixes, open_ends = lattice.tokens, lattice.prefixes, []
        for suffix, before, count in self.states[state]:
            token = suffix + symbol
            if delta is None and token in tokens and lattice.follows(before, token):
                delta, last = count + 1, token
            if token in prefixes:
                open_ends.append((token, before, count))
        if delta is None:
            raise ValueError(f"no token ends in {symbol!r}")
        key = (*[(token, before, count - delta) for token, before, count in open_ends], (b"", last, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        step = self.steps[state << 8 | byte] = to << 8 | delta + 128
        return step

    def count(self, word: bytes) -> int:
        """Number of tokens of ``word``: the sum over the transitions."""
        if len(self.states) > self.most:
            self._reset()
        return self._walk(0, word)[1]

    def run(self, entry: tuple, part: bytes) -> tuple[tuple, int]:
        """The state after ``part`` of a word, read from state ``entry``, and the change of the count."""
        if len(self.states) > self.most:
            self._reset()
        state = self.number.get(entry)
        if state is None:
            state = self.number[entry] = len(self.states)
            self.states.append(entry)
        state, change = self._walk(state, part)
        return self.states[state], change

    def _walk(self, state: int, part: bytes) -> tuple[int, int]:
        total, taken = 0, self.steps.get
        for byte in part:
            step = taken(state << 8 | byte)
            if step is None:
                step = self._compile(state, byte)
            state = step >> 8
            total += (step & 255) - 128
        return state, total
