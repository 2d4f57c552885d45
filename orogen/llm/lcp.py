"""Front-coded sorted runs of byte strings and their merge by an LCP-aware loser tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while known < n:  # by halves
        mid = (known + n + 1) >> 1
        if a[known:mid] == b[known:mid]:
            known = mid
        else:
            n = mid - 1
    return known


def front_code(strings: list[bytes]) -> tuple[bytes, list[int], list[int]]:
    """Sorted ``strings`` as the bytes that follow each one's prefix shared with its predecessor."""
    tails, prefixes, lengths, last = [], [], [], b""
    for s in strings:
        h = shared_prefix(last, s)
        tails.append(s[h:])
        prefixes.append(h)
        lengths.append(len(s))
        last = s
    return b"".join(tails), prefixes, lengths


def front_decode(tails: bytes, prefixes: list[int], lengths: list[int]) -> Iterator[tuple[int, bytes]]:
    """The (shared prefix with the predecessor, string) of each string of a run."""
    at, last = 0, b""
    for h, n in zip(prefixes, lengths, strict=True):
        last = last[:h] + tails[at : at + n - h]
        at += n - h
        yield h, last


def merge(runs: list[Iterable[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge sorted runs of (shared prefix with the run's predecessor, string, payload).

    Yields the same triples in order, the prefix now shared with the merged predecessor.
    Every player of the tree knows its common prefix with the last winner. Of two
    players the one with the longer prefix is smaller and the loser's prefix stays
    right; only players with equal prefixes compare bytes, from that prefix on.
    """
    sources = [iter(r) for r in runs]
    size = 1
    while size < max(1, len(sources)):
        size *= 2
    prefix: list[int] = [0] * size
    head: list[bytes | None] = [None] * size
    load: list[object] = [None] * size
    for i, s in enumerate(sources):
        first = next(s, None)
        if first is not None:
            head[i], load[i] = first[1], first[2]
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); sets the loser's prefix to the one it shares with the winner."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        h = shared_prefix(x, y, prefix[a])
        if x[h:] <= y[h:]:
            prefix[b] = h
            return a, b
        prefix[a] = h
        return b, a

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if size > 1 else 0
    while head[top] is not None:
        yield prefix[top], head[top], load[top]
        following = next(sources[top], None)
        if following is None:
            head[top] = None
        else:
            prefix[top], head[top], load[top] = following
        node = (top + size) >> 1
        while node:  # ``play`` along the path to the root, written out
            other = losers[node]
            y = head[other]
            if y is not None:
                x = head[top]
                own, its = prefix[top], prefix[other]
                if x is None or own < its:
                    losers[node], top = top, other
                elif own == its:
                    h = shared_prefix(x, y, own)
                    if h == len(x) or h < len(y) and x[h] < y[h]:
                        prefix[other] = h
                    else:
                        prefix[top] = h
                        losers[node], top = top, other
            node >>= 1
