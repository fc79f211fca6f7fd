"""Which neighbouring tokens a merge-based vocabulary leaves apart.

A token grows from its symbols by merges of ascending rank. What it shows to
its right neighbour meanwhile are the tokens along its right edge, to its left
neighbour those along its left edge. Two tokens stay apart exactly if no merge
across their border ever comes before the next growth on either side. (At equal rank the leftmost
merge is first: the left token's growth, then the one across, then the right token's.)
"""

from __future__ import annotations

NEVER = 1 << 60


class Merges:
    """``rank``: of each token that merges make, by its text or bytes; lower ranks merge first."""

    def __init__(self, rank: dict):
        self.rank = rank
        self.known: dict = {}

    def merge(self, text) -> list[tuple]:
        """(token, left edge, right edge) of each token that the merges make of ``text``; an edge lists (rank, token) as it
        grows. For single tokens: the time is quadratic."""
        parts = [(text[i:i + 1], [(-1, text[i:i + 1])], [(-1, text[i:i + 1])]) for i in range(len(text))]
        rank = self.rank
        while len(parts) > 1:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i][0] + parts[i + 1][0], NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            (a, left, _), (b, _, right) = parts[at], parts[at + 1]
            parts[at:at + 2] = [(a + b, [*left, (best, a + b)], [*right, (best, a + b)])]
        return parts

    def edges(self, token) -> tuple[list, list] | None:
        """The token's left and right edges; None if the merges don't make it of its own symbols."""
        if token not in self.known:
            parts = self.merge(token)
            whole = len(parts) == 1
            if whole and any(x[i][0] >= x[i + 1][0] for x in parts[0][1:] for i in range(len(x) - 1)):
                raise ValueError(f"{token!r} is made of a later merge's token")
            self.known[token] = (parts[0][1], parts[0][2]) if whole else None
        return self.known[token]

    def apart(self, a, b) -> bool:
        x, y = self.edges(a), self.edges(b)
        if x is None or y is None:
            return False
        left, right = x[1], y[0]
        i = j = 0
        rank = self.rank
        while True:
            grow_a = left[i + 1][0] if i + 1 < len(left) else NEVER
            grow_b = right[j + 1][0] if j + 1 < len(right) else NEVER
            across = rank.get(left[i][1] + right[j][1], NEVER)
            if across < grow_a and across <= grow_b and across < NEVER:
                return False
            if grow_a == grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1
