"""Signature trees: nodes hold the OR of their documents' token bitmaps and the range of their sizes.

Two trees are walked together from the roots. A pair of nodes is given up when its sizes cannot reach the
similarity, when its bitmaps leave less overlap than the least that the sizes ask for, or when all its
documents are connected already. Documents that are left meet in pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FANOUT, LEAF = 8, 16
LEAST_BITS, MOST_BITS = 256, 1 << 16


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of token hashes by their last bits, four bits a token or more, up to ``MOST_BITS``."""
    n_bits = min(max(LEAST_BITS, 1 << (4 * len(tokens)).bit_length()), MOST_BITS)
    marks = np.zeros(n_bits, np.uint8)
    marks[tokens & (n_bits - 1)] = 1
    return np.packbits(marks).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same tokens with ``words`` words of 64 bits."""
    return np.bitwise_or.reduce(bits.reshape(-1, words)) if len(bits) > words else bits


class Forest:
    """Which documents are connected so far."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


class Node:
    """Up to ``FANOUT`` nodes, or up to ``LEAF`` documents.

    ``excess`` is the most tokens of a document that share a bit with another of its own; ``one`` tells that all
    documents below are known to be connected.
    """

    __slots__ = ("bits", "children", "docs", "excess", "high", "low", "one")

    def __init__(self, children: list[Node], docs: list[int]):
        self.children, self.docs, self.one = children, docs, len(docs) == 1
        if children:
            self.bits = np.bitwise_or.reduce([c.bits for c in children])
            self.low, self.high = min(c.low for c in children), max(c.high for c in children)
            self.excess = max(c.excess for c in children)


class Join:
    """Connects documents whose Jaccard similarity may be ``num`` / ``den`` or more, as ``similar`` finds it.

    A document has a bitmap and a size. ``similar`` gets two documents that sizes and bitmaps do not rule out and
    that are not connected yet. ``linked`` may hold a label for each: equal labels are connected from the start.
    """

    def __init__(
        self, bits: list[np.ndarray], sizes: list[int], num: int, den: int, similar: Callable[[int, int], bool], linked: list | None = None
    ):
        words = max(min(map(len, bits)), max(map(len, bits)) // 8) if bits else 1
        rows = [folded(b, words) for b in bits]
        self.sizes = np.array(sizes, np.int64)
        self.excess = self.sizes - [int(np.bitwise_count(b).sum()) for b in rows]
        # a shorter bitmap, repeated, has every bit that a longer one of the same tokens could have
        self.bits = np.stack([np.tile(b, words // len(b)) for b in rows]) if rows else np.empty((0, 1), np.uint64)
        self.num, self.den, self.similar = num, den, similar
        self.forest = Forest(len(sizes))
        first: dict = {}
        for i, label in enumerate(linked or []):
            self.forest.join(first.setdefault(label, i), i)

    def tree(self, docs: list[int], order: Callable[[int], object] | None = None) -> Node:
        """A tree over ``docs`` as ``order`` sorts them, so that alike documents lie next to each other."""
        docs = sorted(docs, key=order) if order else docs
        level = [self._leaf(docs[i : i + LEAF]) for i in range(0, len(docs), LEAF)]
        while len(level) > 1:
            level = [Node(level[i : i + FANOUT], []) for i in range(0, len(level), FANOUT)]
        return level[0]

    def _leaf(self, docs: list[int]) -> Node:
        node = Node([], docs)
        node.bits = np.bitwise_or.reduce(self.bits[docs])
        node.low, node.high = int(self.sizes[docs].min()), int(self.sizes[docs].max())
        node.excess = int(self.excess[docs].max())
        return node

    def _label(self, node: Node) -> int | None:
        """The label of all documents below, or None if they have several. Once one, they stay one."""
        if node.one:
            while node.children:
                node = node.children[0]
            return self.forest.find(node.docs[0])
        labels = {self._label(c) for c in node.children} if node.children else {self.forest.find(d) for d in node.docs}
        if len(labels) == 1 and None not in labels:
            node.one = True
            return labels.pop()
        return None

    def _fits(self, a: Node, b: Node) -> bool:
        """Whether sizes and bitmaps leave room for a pair that is similar enough."""
        num, den = self.num, self.den
        if den * a.high < num * b.low or den * b.high < num * a.low:
            return False
        least = -(-num * (a.low + b.low) // (num + den))  # overlap that similar sets of these sizes need
        return int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.excess, b.excess) >= least

    def _pairs(self, a: list[int], b: list[int]) -> np.ndarray:
        """Places of the pairs that sizes and bitmaps do not rule out."""
        n, m = self.sizes[a][:, None], self.sizes[b][None, :]
        shared = np.bitwise_count(self.bits[a][:, None, :] & self.bits[b][None, :, :]).sum(-1, dtype=np.int64)
        room = shared + np.minimum(self.excess[a][:, None], self.excess[b][None, :])
        near = self.den * np.minimum(n, m) >= self.num * np.maximum(n, m)
        return np.argwhere(near & ((self.num + self.den) * room >= self.num * (n + m)))

    def _meet(self, a: list[int], b: list[int], same: bool) -> None:
        for i, j in self._pairs(a, b):
            x, y = a[i], b[j]
            if (not same or i < j) and self.forest.find(x) != self.forest.find(y) and self.similar(x, y):
                self.forest.join(x, y)

    def within(self, node: Node) -> None:
        """Connects the documents below ``node``."""
        if self._label(node) is not None:
            return
        if node.docs:
            self._meet(node.docs, node.docs, True)
        for c in node.children:
            self.within(c)
        for i, a in enumerate(node.children):
            for b in node.children[i + 1 :]:
                self.between(a, b)

    def between(self, a: Node, b: Node) -> None:
        """Connects documents below ``a`` with documents below ``b``."""
        label = self._label(a)
        if (label is not None and label == self._label(b)) or not self._fits(a, b):
            return
        if a.docs and b.docs:
            self._meet(a.docs, b.docs, False)
        elif b.docs or (a.children and len(a.children) >= len(b.children)):
            for c in a.children:
                self.between(c, b)
        else:
            for c in b.children:
                self.between(a, c)

    def labels(self) -> list[int]:
        return [self.forest.find(i) for i in range(len(self.sizes))]


def exact(sets: list[np.ndarray], num: int, den: int) -> Callable[[int, int], bool]:
    """Whether two of ``sets``, ascending and distinct, have the similarity."""

    def similar(a: int, b: int) -> bool:
        x, y = sets[a], sets[b]
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        shared = int((y[at] == x).sum())
        return den * shared >= num * (len(x) + len(y) - shared)

    return similar
