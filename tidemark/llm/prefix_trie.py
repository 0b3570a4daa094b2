"""A prefix tree over globally ordered shingle sets, and the similarity join on it."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field


@dataclass
class Node:
    """`run` continues the path from the parent; sizes and groups cover the whole subtree."""

    run: tuple[int, ...]
    depth: int = 0  # tokens on the path up to the end of `run`
    children: list[Node] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # places of the sets that end here
    least: int = 0
    most: int = 0
    first: int = 0  # the subtree's sets are order[first:stop]
    stop: int = 0


def build(sets: list[tuple[int, ...]]) -> tuple[Node, list[int]]:
    """The tree of `sets`, each an ascending tuple, and their order in it. Paths without a branch are one node."""
    order = sorted(range(len(sets)), key=sets.__getitem__)
    root = Node((), stop=len(order))
    todo = [(root, order, 0)]
    made = [root]
    while todo:
        node, places, depth = todo.pop()
        at = 0
        while at < len(places) and len(sets[places[at]]) == depth:
            node.ends.append(places[at])
            at += 1
        while at < len(places):
            first, end = sets[places[at]], at + 1
            while end < len(places) and sets[places[end]][depth] == first[depth]:
                end += 1
            last, stop = sets[places[end - 1]], depth + 1
            limit = min(len(first), len(last))
            while stop < limit and first[stop] == last[stop]:  # sorted, so all between share it too
                stop += 1
            child = Node(first[depth:stop], stop, first=node.first + at, stop=node.first + end)
            node.children.append(child)
            made.append(child)
            todo.append((child, places[at:end], stop))
            at = end
    for node in reversed(made):  # children come after their parents
        sizes = [node.depth] * bool(node.ends) + [c.least for c in node.children]
        node.least = min(sizes, default=0)
        node.most = max([node.depth] * bool(node.ends) + [c.most for c in node.children], default=0)
    return root, order


def need(a: int, b: int, num: int, den: int) -> int:
    """Least overlap of sets of `a` and `b` tokens with den * overlap >= num * union."""
    return -(-num * (a + b) // (num + den))


def matches(root: Node, query: tuple[int, ...], num: int, den: int, open_before: list[int] | None = None) -> Iterator[int]:
    """Places of the sets similar to `query`.

    One walk carries the overlap of the shared path down to all sets below it. A subtree is left
    when what it can still add (the fewer of the query's and the subtree's remaining tokens) cannot
    reach the overlap that its smallest admissible set needs. `open_before[k]` counts the sets that
    are still of interest among the first k of the tree's order; subtrees without one are left too.
    """
    n, own = len(query), frozenset(query)
    low, high = -(-num * n // den), den * n // num
    stack = [(root, 0)]
    while stack:
        node, got = stack.pop()
        if node.most < low or node.least > high:
            continue
        if open_before is not None and open_before[node.first] == open_before[node.stop]:
            continue
        if node.run:
            got += len(own.intersection(node.run))
            left = n - bisect_right(query, node.run[-1])
            if got + min(left, node.most - node.depth) < need(n, max(node.least, low), num, den):
                continue
        if node.ends and low <= node.depth <= high and got >= need(n, node.depth, num, den):
            yield from node.ends
        stack.extend((child, got) for child in node.children)
