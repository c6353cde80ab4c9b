"""Signature trees over token sets: dual traversal with pruning by the largest possible overlap."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def bits_of(tokens: np.ndarray, width: int) -> np.ndarray:
    """Bitmap of ``width`` bits (a power of two): the bit of a token is its remainder, so bitmaps fold by OR."""
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits)


def width_for(n: int, least: int = 64) -> int:
    """Bits of the bitmap of ``n`` tokens: the power of two from n on."""
    return max(least, 1 << max(0, n - 1).bit_length())


def fold(bitmap: np.ndarray, width: int) -> np.ndarray:
    while len(bitmap) * 8 > width:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


@dataclass(slots=True)
class Node:
    bits: np.ndarray
    low: int
    high: int
    spare: int  # the most tokens of a member beyond one for each of its bits
    begin: int
    end: int
    left: "Node | None" = None
    right: "Node | None" = None


class SignatureTree:
    """Sets in order of size and similarity; a node has its members' OR-combined bitmap and range of sizes."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        bitmaps = np.ascontiguousarray(bitmaps).view(np.uint64)  # widths are multiples of 64 bits
        self.bitmaps, self.sizes = bitmaps, sizes
        self.spare = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.root = self._build(0, len(sizes)) if len(sizes) else None

    def _build(self, begin: int, end: int) -> Node:
        if end - begin <= LEAF:
            return Node(np.bitwise_or.reduce(self.bitmaps[begin:end]), int(self.sizes[begin:end].min()),
                        int(self.sizes[begin:end].max()), int(self.spare[begin:end].max()), begin, end)
        middle = (begin + end) // 2
        a, b = self._build(begin, middle), self._build(middle, end)
        return Node(a.bits | b.bits, min(a.low, b.low), max(a.high, b.high), max(a.spare, b.spare), begin, end, a, b)


def order_for_tree(sizes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Similar sets side by side: by a sketch (such as the smallest token), then by size."""
    return np.lexsort((sizes, sketches))


def least_overlap(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """The smallest overlap with which sets of these sizes are linked: ceil(percent * (a + b) / (100 + percent))."""
    return -(-percent * (a + b) // (100 + percent))


def dual_traversal(tree: SignatureTree, other: SignatureTree, percent: int, forest: Forest, verify, offset: int = 0) -> None:
    """Join in ``forest`` all pairs of members, one of each tree, that ``verify(i, candidates)`` confirms.

    Positions of ``other`` begin at ``offset`` in the forest (0 with the same tree: a self join). A pair of nodes is
    pruned if their sizes cannot be similar, if the bits they share (plus what bitmaps may hide) are too few for the
    overlap that their smallest members would need, or if all their members are joined already.
    """
    if tree.root is None or other.root is None:
        return
    same = tree is other
    together: dict[int, tuple[int, int | None]] = {}

    def joined(node: Node, shift: int) -> int | None:
        """The common root of a node's members, if they have one."""
        key = (id(node), shift)
        if (known := together.get(key)) is not None:
            return forest.find(known)
        first = forest.find(node.begin + shift)
        for i in range(node.begin + 1, node.end):
            if forest.find(i + shift) != first:
                return None
        together[key] = first
        return first

    stack = [(tree.root, other.root)]
    while stack:
        a, b = stack.pop()
        if same and a.begin > b.begin:
            continue
        if a.high * 100 < percent * b.low or b.high * 100 < percent * a.low:
            continue
        need = least_overlap(a.low, b.low, percent)
        if not (same and a is b):
            shared = int(np.bitwise_count(a.bits & b.bits).sum())
            if shared + min(a.spare, b.spare) < need:
                continue
        ra = joined(a, 0)
        if ra is not None and ra == joined(b, offset):
            continue
        if a.left is None and b.left is None:
            n, m = tree.sizes[a.begin: a.end, None], other.sizes[None, b.begin: b.end]
            fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            if same and a is b:
                fits &= np.tri(len(n), k=-1, dtype=bool).T
            ii, jj = np.nonzero(fits)
            ii, jj = ii + a.begin, jj + b.begin
            shared = np.bitwise_count(tree.bitmaps[ii] & other.bitmaps[jj]).sum(axis=1, dtype=np.int64)
            near = shared + np.minimum(tree.spare[ii], other.spare[jj]) >= least_overlap(
                tree.sizes[ii], other.sizes[jj], percent)
            for i, j in zip(ii[near].tolist(), jj[near].tolist()):
                if forest.find(i) != forest.find(j + offset) and verify(i, j):
                    forest.join(i, j + offset)
        elif b.left is None or (a.left is not None and a.end - a.begin >= b.end - b.begin):
            if same and a is b:
                stack += [(a.left, a.left), (a.left, a.right), (a.right, a.right)]
            else:
                stack += [(a.left, b), (a.right, b)]
        else:
            stack += [(a, b.left), (a, b.right)]
