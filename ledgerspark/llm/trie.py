"""A prefix tree of ordered sets, joined with one set at a time."""

from __future__ import annotations


class Trie:
    """Sets as ascending lists of ranked elements; sets that begin alike share their way.

    A node is [elements of its edge, children by first element, sets that end here, least full size below,
    most elements below]. The full size of a set may exceed its list: elements that no other set has are left out.
    """

    def __init__(self):
        self.root: list = [(), {}, [], None, 0]

    def add(self, items: tuple[int, ...], size: int, name) -> None:
        node, at = self.root, 0
        while True:
            node[3] = size if node[3] is None else min(node[3], size)
            node[4] = max(node[4], len(items) - at)
            if at == len(items):
                node[2].append((name, size))
                return
            child = node[1].get(items[at])
            if child is None:
                node[1][items[at]] = [items[at:], {}, [(name, size)], size, 0]
                return
            edge, same = child[0], 1
            while same < len(edge) and at + same < len(items) and edge[same] == items[at + same]:
                same += 1
            if same < len(edge):
                rest = [edge[same:], child[1], child[2], child[3], child[4]]
                child[0], child[1], child[2] = edge[:same], {edge[same]: rest}, []
                child[4] += len(edge) - same
            node, at = child, at + same

    def similar(self, items: tuple[int, ...], size: int, percent: int = 75):
        """(name, overlap) of every set whose Jaccard similarity with the given one is at least percent / 100.

        Overlaps are counted once per shared way. A subtree goes as soon as what is left of its longest set and of the
        given one cannot bring the overlap to what its smallest set needs.
        """
        place = {x: i for i, x in enumerate(items)}
        total = len(items)
        stack = [(child, 0, 0) for child in self.root[1].values()]
        for name, other in self.root[2]:
            if 0 >= need(size, other, percent):
                yield name, 0
        while stack:
            (edge, children, ends, least, below), overlap, passed = stack.pop()
            wanted = need(size, least, percent)
            left = len(edge) + below
            if overlap + min(left, total - passed) < wanted:
                continue
            alive = True
            for x in edge:
                left -= 1
                at = place.get(x)
                if at is not None:
                    overlap += 1
                    passed = at + 1
                elif overlap + min(left, total - passed) < wanted:
                    alive = False
                    break
            if alive:
                for name, other in ends:
                    if overlap >= need(size, other, percent):
                        yield name, overlap
                stack.extend((child, overlap, passed) for child in children.values())


def need(a: int, b: int, percent: int = 75) -> int:
    """Least overlap with which sets of sizes a and b reach percent / 100."""
    return -(-percent * (a + b) // (100 + percent))
