"""Deep-shallow suffix sorting: multikey quicksort to a shallow depth, blind tries below it.

Small and plain: a task calls it on the texts of one bucket at a time, which are few and bounded.
"""

from __future__ import annotations



def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix, given that `start` bytes agree."""
    most = min(len(a), len(b))
    low, step = start, 16
    while low < most:
        high = min(low + step, most)
        if a[low:high] == b[low:high]:
            low, step = high, step * 2
            continue
        if high - low == 1:
            return low
        step = max(1, (high - low) // 2)
    return most


def _at(text: bytes, depth: int) -> int:
    return text[depth] if depth < len(text) else -1


class BlindTrie:
    """Inner nodes keep a branching depth and one byte an edge; only leaves name texts, so each insertion compares one
    pair of texts. A node is [depth, {byte: node}]; a leaf is a list of equal texts, as (-1, members)."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.root = None

    def insert(self, k: int, known: int) -> None:
        """`known`: bytes in which all texts of the trie agree."""
        text = self.texts[k]
        if self.root is None:
            self.root = (-1, [k])
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(_at(text, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = self.texts[node[1][0]]
        depth = common(text, other, known)
        if depth == len(text) == len(other):
            node[1].append(k)
            return
        above, edge, node = None, None, self.root
        while 0 <= node[0] < depth:
            above, edge = node, _at(text, node[0])
            node = node[1][edge]
        if node[0] == depth:
            node[1][_at(text, depth)] = (-1, [k])
            return
        fork = (depth, {_at(other, depth): node, _at(text, depth): (-1, [k])})
        if above is None:
            self.root = fork
        else:
            above[1][edge] = fork

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[0] < 0:
                out.extend(node[1])
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        return out


def deep_shallow(texts: list[bytes], shallow: int = 32, step: int = 8) -> list[int]:
    """The order of `texts`. Multikey quicksort compares `step` bytes at a time down to `shallow`; groups that agree so
    far are ordered by a blind trie."""
    out: list[int] = []
    stack = [(list(range(len(texts))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group[0])
            continue
        if depth >= shallow:
            trie = BlindTrie(texts)
            for k in group:
                trie.insert(k, depth)
            out.extend(trie.order())
            continue
        pivot = texts[group[len(group) // 2]][depth : depth + step]
        less, equal, more = [], [], []
        for k in group:
            part = texts[k][depth : depth + step]
            (equal if part == pivot else less if part < pivot else more).append(k)
        if more:
            stack.append((more, depth))
        if len(pivot) < step:  # these end here, alike
            stack.extend(([k], depth) for k in reversed(equal))
        else:
            stack.append((equal, depth + step))
        if less:
            stack.append((less, depth))
    return out


class Sorted:
    """Order, ranks and, by rank, the common prefix with the text before; minima over ranges in constant time."""

    def __init__(self, texts: list[bytes]):
        self.order = deep_shallow(texts)
        self.rank = [0] * len(texts)
        for r, k in enumerate(self.order):
            self.rank[k] = r
        lcp = [0] + [common(texts[a], texts[b]) for a, b in zip(self.order, self.order[1:])]
        self.levels = [lcp]
        width = 1
        while 2 * width < len(lcp):
            last = self.levels[-1]
            self.levels.append([min(last[k], last[k + width]) for k in range(len(last) - width)])
            width *= 2

    def common(self, low: int, high: int) -> int:
        """Of the texts of ranks low < high."""
        level = (high - low).bit_length() - 1
        row = self.levels[level]
        return min(row[low + 1], row[high - (1 << level) + 1])
