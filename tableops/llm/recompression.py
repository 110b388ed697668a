"""Recompression: a sequence of symbols as a run-length grammar, built level by level in numpy.

Levels alternate. A block level names each stretch of one symbol by (symbol, length). A pair level
deals the symbols to two sides by a hash and names each (left, right) neighbour pair; what is in no
pair stays alone. Both depend on the symbols at a border only, so equal stretches are named alike
but for a symbol or a block at either end. That gives exact extensions: a query climbs while the
symbols of a level agree, eating one symbol (or the common part of a block) where a border of the
next level lies inside, and where symbols differ goes down again to the first word that differs.

Levels are built when a query first climbs to them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


class Level:
    """Symbols, and for the next level: each symbol's parent, and each parent's first child."""

    __slots__ = ("blocks", "first", "symbols", "up")

    def __init__(self, symbols: np.ndarray) -> None:
        self.symbols, self.up, self.first, self.blocks = symbols, None, None, False


class Grammar:
    """Extensions in a sequence whose first and last symbol occur nowhere else in it."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.levels = [Level(np.ascontiguousarray(symbols, np.int64))]

    def _grown(self, t: int) -> Level:
        """Level t with its links to level t + 1, which is made if it isn't there."""
        level = self.levels[t]
        if level.up is None:
            s = level.symbols
            starts = np.empty(len(s), bool)
            starts[0] = True
            np.not_equal(s[1:], s[:-1], out=starts[1:])
            level.blocks = not starts.all()
            if level.blocks:
                first = np.flatnonzero(starts)
                keys = (s[first] << 32) | np.diff(first, append=len(s))
            else:
                starts[1:] = ~self._pairs(s, t)
                first = np.flatnonzero(starts)
                double = np.diff(first, append=len(s)) == 2
                second = np.where(double, s[np.minimum(first + 1, len(s) - 1)] + 1, 0)
                keys = (s[first] << 32) | second
            level.up = np.cumsum(starts, dtype=np.int64) - 1
            level.first = np.append(first, len(s))
            self.levels.append(Level(pd.factorize(keys)[0].astype(np.int64)))
        return level

    @staticmethod
    def _pairs(s: np.ndarray, t: int) -> np.ndarray:
        """Which neighbours (i, i + 1) are a pair; neighbours differ here."""
        salt = t
        while True:
            # a side for each symbol: a bit of its hash
            mixed = (s.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            side = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(bool)
            one, other = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
            found = one if one.sum() >= other.sum() else other
            if found.any() or len(s) < 2:
                return found
            salt += 1_000_003

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from positions a and b on, to the right (1) or left (-1)."""
        result = np.zeros(len(a), np.int64)
        if not len(a):
            return result
        query, x, y, t = np.arange(len(a)), a.copy(), b.copy(), 0
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(query):
            symbols = self.levels[t].symbols
            differ = symbols[x] != symbols[y]
            stops = [(query[differ], x[differ], y[differ])]
            query, x, y = query[~differ], x[~differ], y[~differ]
            if len(query):
                level = self._grown(t)
                inside = ~(self._border(level, x, step) & self._border(level, y, step))
                eaten = self._common(level, x, y, step) if level.blocks else 1
                eaten = np.where(inside, eaten, 0)
                x, y = x + step * eaten, y + step * eaten
                open_ = ~(self._border(level, x, step) & self._border(level, y, step))
                stops.append((query[open_], x[open_], y[open_]))
                query, x, y = query[~open_], level.up[x[~open_]], level.up[y[~open_]]
            stopped.append(tuple(np.concatenate(c) for c in zip(*stops, strict=True)))
            t += 1
        # down again: on every level x and y stand on the first symbols that differ
        query, x, y = stopped.pop()
        while stopped:
            level = self.levels[len(stopped) - 1]
            lowest, after = level.first[x], level.first[x + 1]
            lowest_y, after_y = level.first[y], level.first[y + 1]
            children = np.minimum(after - lowest, after_y - lowest_y) if level.blocks else 1
            x, y = (lowest, lowest_y) if step > 0 else (after - 1, after_y - 1)
            eaten = np.where(level.symbols[x] == level.symbols[y], children, 0)
            x, y = x + step * eaten, y + step * eaten
            more = stopped.pop()
            query, x, y = (np.concatenate(c) for c in zip((query, x, y), more, strict=True))
        result[query] = (x - a[query]) * step
        return result

    @staticmethod
    def _border(level: Level, x: np.ndarray, step: int) -> np.ndarray:
        """A symbol of the next level begins (1) or ends (-1) at x."""
        if step > 0:
            return level.first[level.up[x]] == x
        return level.first[level.up[x] + 1] - 1 == x

    @staticmethod
    def _common(level: Level, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """What is left of both blocks."""
        if step > 0:
            return np.minimum(level.first[level.up[x] + 1] - x, level.first[level.up[y] + 1] - y)
        return np.minimum(x - level.first[level.up[x]], y - level.first[level.up[y]]) + 1
