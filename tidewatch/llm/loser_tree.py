"""Merging sorted runs of byte strings with a loser tree that knows common prefixes.

Every string that waits in the tree carries the length of the prefix it shares with the last
string put out. Of two that share prefixes of different lengths, the one that shares more is
smaller; only when both share equally much are bytes compared, from there on. So no prefix that
is known to be common is compared again.
"""

from __future__ import annotations

from collections.abc import Iterator


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """The length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x, y = int.from_bytes(a[start:n]), int.from_bytes(b[start:n])
    return start + (n - start) - ((x ^ y).bit_length() + 7 >> 3)


def merge(runs: list[list[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge runs of (prefix shared with the one before in the run, string, payload).

    Yields the same triples in the order of the strings (equal ones by run), with the prefix
    that each shares with the one put out before it.
    """
    k = max(1, len(runs))
    feeds = [iter(r) for r in runs]
    head = [next(f, None) for f in feeds]
    head = [None if h is None else (0, h[1], h[2]) for h in head]
    loser = [-1] * k                       # loser[i]: the run that lost at inner node i

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of runs a and b; the loser's prefix becomes that shared with the winner."""
        if a < 0 or head[a] is None:
            return b, a
        if b < 0 or head[b] is None:
            return a, b
        (p, s, x), (q, t, y) = head[a], head[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        c = common(s, t, p)
        first = (s[c:c + 1], a) <= (t[c:c + 1], b)
        if first:
            head[b] = (c, t, y)
            return a, b
        head[a] = (c, s, x)
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while winner >= 0 and head[winner] is not None:
        yield head[winner]
        head[winner] = next(feeds[winner], None)
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            winner, loser[node] = play(winner, loser[node])
            node //= 2
