"""A suffix tree over numbers, built from left to right, and longest common extensions by its tour."""

from __future__ import annotations

import numpy as np

END = -1


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers >= 0, closed by an end mark that sorts before all of them.

    A tour of the tree with children in order visits the suffixes in order. Between two neighbouring
    leaves it comes back to their lowest common ancestor; the depths of these, with a sparse table of
    minima above them, give the common start of any two suffixes in constant time.
    """

    def __init__(self, numbers: np.ndarray):
        self.text = np.append(np.asarray(numbers, np.int64), END)
        self._grow(self.text.tolist())
        self.order, self.shared = self._tour(rising=True)
        self.rank = np.empty(len(self.text), np.int64)
        self.rank[self.order] = np.arange(len(self.text))
        self._minima: list[np.ndarray] | None = None

    def _grow(self, text: list[int]) -> None:
        """Nodes as lists: where a node's edge starts and stops in the text, and its parent."""
        size, wide = len(text), max(text) + 2
        first, last, link, up = [0], [0], [0], [0]
        go: dict[int, int] = {}
        node = edge = length = rest = 0
        for i, symbol in enumerate(text):
            open_ = 0  # the inner node made last, which waits for its suffix link
            rest += 1
            while rest:
                if not length:
                    edge = i
                key = node * wide + text[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(first)
                    first.append(i)
                    last.append(size)
                    link.append(0)
                    up.append(node)
                    if open_:
                        link[open_] = node
                        open_ = 0
                else:
                    begin = first[child]
                    span = min(last[child], i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if open_:
                            link[open_] = node
                        break
                    middle = len(first)
                    first += (begin, i)
                    last += (begin + length, size)
                    link += (0, 0)
                    up += (node, middle)
                    go[key] = middle
                    go[middle * wide + symbol] = middle + 1
                    first[child] = begin + length
                    up[child] = middle
                    go[middle * wide + text[begin + length]] = child
                    if open_:
                        link[open_] = middle
                    open_ = middle
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self._first, self._up = np.array(first), np.array(up)
        self._width = np.array(last) - self._first

    def _tour(self, rising: bool) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and before each but the first the depth of what it shares with its neighbour.

        With `rising` false numbers are ordered from the greatest down; the end mark stays before all.
        """
        head = self.text[self._first]
        symbol = np.where(head == END, head, head if rising else head.max() + 1 - head)
        nodes = np.lexsort((-symbol, self._up))
        nodes = nodes[nodes != 0]
        count = np.bincount(self._up[nodes], minlength=len(self._up))
        stop = np.cumsum(count)
        low, high, kids = (stop - count).tolist(), stop.tolist(), nodes.tolist()
        up, width, depth = self._up.tolist(), self._width.tolist(), [0] * len(count)
        visited, stack = [], kids[low[0] : high[0]]
        while stack:
            v = stack.pop()
            visited.append(v)
            depth[v] = depth[up[v]] + width[v]
            a, b = low[v], high[v]
            if a < b:
                stack += kids[a:b]
        met, deep = np.array(visited), np.array(depth)
        eldest = np.zeros(len(count), bool)
        eldest[nodes[stop[count > 0] - 1]] = True  # children are stacked from the last to the first
        leaves = met[count[met] == 0]
        return len(self.text) - deep[leaves], deep[self._up[met[~eldest[met]]]]

    def falling_rank(self) -> np.ndarray:
        """Places of the suffixes when numbers are ordered from the greatest down."""
        order, _ = self._tour(rising=False)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common start of the suffixes at `a` and at `b`, which differ, place by place."""
        if self._minima is None:
            level = self.shared.astype(np.int32)
            self._minima = [level]
            while 2 ** len(self._minima) <= len(self.shared):
                half = 2 ** (len(self._minima) - 1)
                level = np.minimum(level[:-half], level[half:])
                self._minima.append(level)
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        step = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(step).tolist():
            at = step == k
            table = self._minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - 2**k])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place but the last, the next one of smaller rank. The last place has the least rank."""
    values, stack = rank.tolist(), [len(rank) - 1]
    found = [0] * (len(values) - 1)
    for i in range(len(values) - 2, -1, -1):
        value = values[i]
        while values[stack[-1]] > value:
            stack.pop()
        found[i] = stack[-1]
        stack.append(i)
    return np.array(found, np.int64)
