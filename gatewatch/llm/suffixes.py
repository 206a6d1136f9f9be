"""Deep-shallow ordering of byte strings, for many groups at once.

``order_within`` sorts strings inside their groups in two steps. A multikey
quicksort looks at eight bytes at a time (numpy partitions the tied ranges of
all groups in one call) down to a shallow depth. Ranges that are still tied
share a long prefix; a blind trie orders each of them: it stores only the
positions at which its strings branch, finds a string's place by looking at
those positions alone, and compares it in full with a single string.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64
_STEP = 8


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    m = min(len(a), len(b))
    a, b = a[:m], b[:m]
    if a == b:
        return m
    return m - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


class BlindTrie:
    """Patricia trie over distinct branches; equal strings share a leaf.

    A node is [depth, {byte or -1 (end of string): child}, any index below]; a
    leaf is a list of string indices, kept as [None, indices, index]."""

    def __init__(self, strings):
        self.strings, self.root = strings, None

    @staticmethod
    def _at(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def add(self, i: int) -> None:
        s = self.strings[i]
        leaf = [None, [i], i]
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while node[0] is not None:  # blind descent
            node = node[1].get(self._at(s, node[0])) or next(iter(node[1].values()))
        other = self.strings[node[2]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node[1].append(i)
            return
        parent, node = None, self.root
        while node[0] is not None and node[0] < depth:
            parent, node = node, node[1][self._at(s, node[0])]
        if node[0] == depth:
            node[1][self._at(s, depth)] = leaf
            return
        fork = [depth, {self._at(s, depth): leaf, self._at(self.strings[node[2]], depth): node}, i]
        if parent is None:
            self.root = fork
        else:
            parent[1][self._at(s, parent[0])] = fork

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                out.extend(node[1])
            else:
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
        return out


def order_within(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): row numbers sorted by (group, string), and each one's
    common prefix with the one before it, -1 at the start of a group.
    ``group`` must be non-decreasing."""
    n = len(strings)
    head = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(n, SHALLOW // _STEP)
    order = np.arange(n)
    rng = group.astype(np.int64)  # range number of each place, non-decreasing
    tied = np.ones(n, bool)
    for depth in range(SHALLOW // _STEP):
        places = np.flatnonzero(tied)
        if not len(places):
            break
        rows = order[places]
        word = head[rows, depth].astype(np.uint64)
        by = np.lexsort((rows, word, rng[places]))
        order[places], word = rows[by], word[by]
        # Split ranges where the word changes (a range keeps its places).
        new = np.zeros(n, bool)
        new[1:] = rng[1:] != rng[:-1]
        inner = np.flatnonzero((word[1:] != word[:-1])) + 1
        new[places[inner]] = True
        rng = np.cumsum(new)
        size = np.bincount(rng)
        tied = size[rng] > 1
    for a, b in _ranges(rng, tied):
        trie = BlindTrie(strings)
        for i in order[a:b].tolist():
            trie.add(i)
        order[a:b] = trie.ordered()
    lcp = np.full(n, -1, np.int64)
    g = group[order]
    rows = order.tolist()
    for k in np.flatnonzero(g[1:] == g[:-1]).tolist():
        lcp[k + 1] = common(strings[rows[k]], strings[rows[k + 1]])
    return order, lcp


def _ranges(rng: np.ndarray, tied: np.ndarray):
    """(first, end) of the ranges of more than one place."""
    edges = np.flatnonzero(np.diff(rng, prepend=-1, append=rng[-1] + 1 if len(rng) else 0))
    return [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if b - a > 1 and tied[a]]
