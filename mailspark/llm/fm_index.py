"""A compressed full-text index of word numbers: wavelet matrix over the BWT.

Matching statistics: backward search takes many texts, which need not be in the index, one
word further at a time.  A match that can't be prolonged shrinks until it can: with the
word before it, it falls between two suffixes, and what it has in common with the nearer
one is the longest match, whose interval the common prefixes of neighbours bound.  A bit for each pair of neighbouring suffixes says where they differ within the first
``window`` tokens, so a match that grew beyond the window shrinks to the window's range.
"""

from __future__ import annotations

import numpy as np

from mailspark.llm.repetition import suffix_order

_WORD = 64


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // _WORD) * _WORD, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        part = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word].astype(np.int64) + np.bitwise_count(part)


class Parents:
    """Intervals around places of an array of common prefixes, from minima of blocks."""

    def __init__(self, common: np.ndarray):
        self.common = common
        levels = [common]
        while len(levels[-1]) > 1:
            # An odd end has itself for its other half.
            if len(levels[-1]) & 1:
                levels[-1] = np.append(levels[-1], levels[-1][-1])
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        self.starts = np.cumsum([0, *map(len, levels)])
        self.least = np.concatenate(levels)

    def around(self, at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last place up to each and the first beyond it with a value under ``least``;
        the array's ends have one."""
        n = len(at)
        back = np.arange(2 * n) < n
        at, least = np.append(at, at + 1), np.append(least, least)
        # Up to the block of twice the size whenever one begins, down where a value is in.
        found = np.empty(2 * n, np.int64)
        step = np.where(back, -1, 1)
        which, level, up = np.arange(2 * n), np.zeros(2 * n, np.int64), np.ones(2 * n, bool)
        while len(which):
            hit = self.least[self.starts[level] + at] < least
            done = hit & (level == 0)
            if done.any():
                found[which[done]] = at[done]
                stay = ~done
                which, level, up, at, hit = which[stay], level[stay], up[stay], at[stay], hit[stay]
                least, back, step = least[stay], back[stay], step[stay]
            at = np.where(hit, 2 * at + back, at + step)
            up &= ~hit
            rise = up & ((at & 1) == back)
            at, level = np.where(rise, at >> 1, at), level + rise - hit
        return found[:n], found[n:]


class FMIndex:
    """Index of ``tokens``: numbers from 1 on, 0 between texts; owners by token.

    ``symbols`` is above all numbers, those of streamed texts too.
    """

    def __init__(self, tokens: np.ndarray, owners: np.ndarray, window: int, symbols: int = 0):
        n = len(tokens)
        order, rounds = suffix_order(tokens, 2 * window)
        symbols = max(symbols, int(tokens.max(initial=0)) + 1)
        counts = np.bincount(tokens, minlength=symbols)
        self.size, self.window = n, window
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self._wavelet(tokens[order - 1] * (order > 0), symbols)
        # Neighbours that agree in the window: in its first and its last 2**k tokens.
        k = min(window.bit_length() - 1, len(rounds) - 1)
        ranks, rest = rounds[k], window - (1 << k)
        a, b = order[:-1], order[1:]
        same = ranks[a] == ranks[b]
        same &= ranks[np.minimum(a + rest, n)] == ranks[np.minimum(b + rest, n)]
        starts = np.flatnonzero(np.append(True, ~same)) if n else np.zeros(0, np.int64)
        self.class_bits = Bits(np.append(True, ~same) if n else np.zeros(0, bool))
        self.class_start = np.append(starts, n)
        self.class_owner = np.minimum.reduceat(owners[order], starts) if n else owners
        # What a suffix has in common with the one before, the window at most.
        common = np.full(n + 1, -1, np.int64)
        if n:
            self.order, self.rounds = order, rounds
            common[1:n] = self.in_common(a, b)
        self.parents = Parents(common)

    def _wavelet(self, bwt: np.ndarray, symbols: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        self.base = np.zeros(symbols, np.int64)
        names = np.arange(symbols)
        for bit in reversed(range(max(1, (symbols - 1).bit_length()))):
            ones = (bwt >> bit & 1).astype(bool)
            bits, zeros = Bits(ones), int(len(bwt) - ones.sum())
            self.levels.append((bit, bits, zeros))
            bwt = np.concatenate([bwt[~ones], bwt[ones]])
            self.base = self._down(self.base, names, bit, bits, zeros)

    @staticmethod
    def _down(i: np.ndarray, symbol: np.ndarray, bit: int, bits: Bits, zeros: int) -> np.ndarray:
        ones = bits.ones(i)
        return np.where(symbol >> bit & 1, zeros + ones, i - ones)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the BWT."""
        for bit, bits, zeros in self.levels:
            i = self._down(i, symbol, bit, bits, zeros)
        return i - self.base[symbol]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        """The ranges of suffixes after putting a symbol before each match."""
        both = self.rank(np.append(symbol, symbol), np.append(low, high))
        n = len(symbol)
        return self.first[symbol] + both[:n], self.first[symbol] + both[n:]

    def window_class(self, low: np.ndarray) -> np.ndarray:
        """The class, of suffixes that agree in the window, at each place."""
        return self.class_bits.ones(low + 1) - 1

    def in_common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many tokens the suffixes from two places of the text share, the window at most."""
        shared = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.rounds))):
            ranks = self.rounds[k]
            equal = ranks[np.minimum(a + shared, self.size)] == ranks[np.minimum(b + shared, self.size)]
            shared += equal.astype(np.int64) << k
        return np.where(a == b, self.window, np.minimum(shared, self.window))

    def shrunk(self, symbol: np.ndarray, low: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple:
        """The longest match that begins with a symbol and goes on as the matches at ``low``
        do, of which no whole one does: its range and length.  ``at``: where it would stand
        among the suffixes; the one before or the one there has most in common with it."""
        begin = self.first[symbol]
        end = np.append(self.first, self.size)[symbol + 1]
        text = self.order[low]
        best, near = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
        for other, known in ((at - 1, at > begin), (at, at < end)):
            other = np.where(known, other, 0)
            common = self.in_common(text, np.minimum(self.order[other] + 1, self.size))
            common = np.where(known, np.minimum(common, length), -1)
            near = np.where(common > best, other, near)
            best = np.maximum(best, common)
        # A symbol that isn't indexed at all matches nothing: length 0, all suffixes.
        low, high = self.parents.around(near, best + 1)
        return low, high, best + 1

    def matches(self, tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple:
        """At every place of the streamed texts the length of the longest match that begins
        there, the window at most, and the least owner of those of a window's length (-1
        elsewhere).  All texts are taken together, from their ends on."""
        lengths = np.zeros(len(tokens), np.int64)
        found = np.full(len(tokens), -1, np.int64)
        by = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[by], sizes[by]
        low = np.zeros(len(by), np.int64)
        high = np.full(len(by), self.size, np.int64)
        length = np.zeros(len(by), np.int64)
        for step in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -step, side="left"))
            low, high, length = low[:n], high[:n], length[:n]
            place = begins[:n] + sizes[:n] - 1 - step
            symbol = tokens[place]
            below, above = self.extend(symbol, low, high)
            longer = below < above
            stuck = np.flatnonzero(~longer)
            low, high, length = np.where(longer, below, low), np.where(longer, above, high), length + longer
            if len(stuck):
                low[stuck], high[stuck], length[stuck] = self.shrunk(
                    symbol[stuck], low[stuck], length[stuck], below[stuck]
                )
            whole = np.flatnonzero(length >= self.window)
            own = self.window_class(low[whole])
            low[whole], high[whole] = self.class_start[own], self.class_start[own + 1]
            length[whole] = self.window
            lengths[place] = length
            found[place[whole]] = self.class_owner[own]
        return lengths, found
