"""The prefix tree of one group of sets, and the search for linked sets in it."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Members of a path that are compared at once; bounds are looked at after each such block.
BLOCK = 16


@dataclass
class Entry:
    """A set: its size, and those of its members that other sets of the group have too, as ranks in the group's order."""

    size: int
    tokens: list[int]
    members: frozenset = frozenset()

    def __post_init__(self) -> None:
        self.members = frozenset(self.tokens)


def ranked(sets: list[np.ndarray], sizes: list[int]) -> list[Entry]:
    """Entries in one order for the whole group: members of few sets first, then by value. Members of a single set match nothing and are left out."""
    cut = np.cumsum([0] + [len(s) for s in sets])
    values, number, times = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.int64), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(values))
    common, place = times[number] > 1, rank[number]
    return [Entry(n, np.sort(place[a:b][common[a:b]]).tolist()) for n, a, b in zip(sizes, cut[:-1].tolist(), cut[1:].tolist())]


@dataclass
class Branch:
    blocks: list[list[int]]  # members that all sets below share, after those of the branches above
    low: int  # sizes of the sets below
    high: int
    longest: int  # most members of a set below
    ends: list[int]  # sets that end here
    children: list["Branch"] = field(default_factory=list)
    alike: int | None = None  # a set below, if all below are known to be of one component


class Union:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.parts = n

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.parts -= 1
        return x != y


@dataclass
class Forest:
    tops: list[Branch]  # one for each first member
    index: dict[int, set[int]]  # for a member the tops below which a set has it in its prefix


def prefix(e: Entry, percent: int) -> list[int]:
    """The members of which a set that links to e has one in its own prefix; those left out of the entry come first and match nothing."""
    return e.tokens[: max(0, len(e.tokens) - -(-percent * e.size // 100) + 1)]


def build(entries: list[Entry], which: list[int], percent: int) -> Forest:
    """The trees of the given entries. Chains of single branches are one path."""
    order = sorted((i for i in which if entries[i].tokens), key=lambda i: entries[i].tokens)
    forest, tops = Forest([], {}), []
    todo = []
    for n, i in enumerate(order):
        if not n or entries[i].tokens[0] != entries[order[n - 1]].tokens[0]:
            tops.append(n)
        for t in prefix(entries[i], percent):
            forest.index.setdefault(t, set()).add(len(tops) - 1)
    for lo, hi in zip(tops, [*tops[1:], len(order)]):
        todo.append((lo, hi, 0, forest.tops))
    todo.reverse()  # so that tops keep their order
    while todo:
        lo, hi, depth, into = todo.pop()
        first, last = entries[order[lo]].tokens, entries[order[hi - 1]].tokens  # sorted: what these two share, all share
        to, most = depth, min(len(first), len(last))
        while to < most and first[to] == last[to]:
            to += 1
        sizes = [entries[i].size for i in order[lo:hi]]
        end = lo
        while end < hi and len(entries[order[end]].tokens) == to:
            end += 1
        blocks = [first[i : min(i + BLOCK, to)] for i in range(depth, to, BLOCK)]
        b = Branch(blocks, min(sizes), max(sizes), max(len(entries[i].tokens) for i in order[lo:hi]), order[lo:end])
        into.append(b)
        at = end
        while at < hi:
            token, to_at = entries[order[at]].tokens[to], at + 1
            while to_at < hi and entries[order[to_at]].tokens[to] == token:
                to_at += 1
            todo.append((at, to_at, to, b.children))
            at = to_at
    return forest


def relabel(forest: Forest, union: Union) -> None:
    """Marks the branches whose sets are all of one component."""
    stack, order = list(forest.tops), []
    while stack:
        b = stack.pop()
        order.append(b)
        stack += b.children
    for b in reversed(order):
        roots = {union.find(i) for i in b.ends} | {None if c.alike is None else union.find(c.alike) for c in b.children}
        b.alike = next(iter(roots)) if len(roots) == 1 else None


def search(forest: Forest, entries: list[Entry], q: int, percent: int, skip: Callable[[int], bool] | None = None, walked: list[int] | None = None) -> Iterator[int]:
    """Every set of the forest that links to q, but for those below branches that `skip` declines.

    It begins with the trees that hold a member of q's prefix in the prefix of a set. Overlaps counted
    on a branch hold for all sets below it. Members come in one order, so those of q that precede the
    path's last one can't be met below: a branch is left when even all that remains of its longest
    set, or of q, can't reach the overlap that its least set needs. walked[0] counts the members
    compared.
    """
    a, size, members = entries[q].tokens, entries[q].size, entries[q].members
    whole = len(a)
    tops = {t for m in prefix(entries[q], percent) for t in forest.index.get(m, ())}
    stack = [(forest.tops[t], 0, 0, 0) for t in sorted(tops, reverse=True)]  # branch, depth above it, overlap so far, first member of q that may still be met
    while stack:
        b, depth, overlap, rest = stack.pop()
        if 100 * b.high < percent * size or 100 * size < percent * b.low or (skip and b.alike is not None and skip(b.alike)):
            continue
        need = -(-percent * (size + max(b.low, -(-percent * size // 100))) // (100 + percent))
        if overlap + min(b.longest - depth, whole - rest) < need:
            continue
        for block in b.blocks:
            depth += len(block)
            if walked:
                walked[0] += len(block)
            overlap += len(members.intersection(block))
            rest = bisect_right(a, block[-1], rest)
            if overlap + min(b.longest - depth, whole - rest) < need:
                break
        else:
            for i in b.ends:
                if i != q and (100 + percent) * overlap >= percent * (size + entries[i].size):
                    yield i
            for c in b.children:
                stack.append((c, depth, overlap, rest))


def join(entries: list[Entry], left: list[int], right: list[int], percent: int, known: list[int | None] | None = None) -> list[tuple[int, int]]:
    """Links that connect all entries of right with all of left that they link to, one for each step of a spanning forest.

    Entries of the same known component are held to be joined; those equal in all their members are
    joined first. Branches whose sets are all of the asking
    set's component are skipped; they are marked anew after 1, 2, 4, ... searches.
    """
    union, links = Union(len(entries)), []
    same: dict[tuple, int] = {}
    once = []
    component: dict[int, int] = {}
    for i, k in enumerate(known or ()):
        if k is not None:
            union.join(component.setdefault(k, i), i)
    for i, e in enumerate(entries):
        j = same.setdefault(tuple(e.tokens), i) if len(e.tokens) == e.size else i
        once.append(j)
        if j != i and union.join(i, j):
            links.append((i, j))
    keep, ask = sorted({once[i] for i in left}), sorted({once[i] for i in right})
    tree = build(entries, keep, percent)
    relabel(tree, union)
    mark = 1
    for n, q in enumerate(ask, 1):
        for i in search(tree, entries, q, percent, lambda x: union.find(x) == union.find(q)):  # noqa: B023
            if union.join(q, i):
                links.append((q, i))
        if union.parts == 1:
            break
        if n == mark:
            relabel(tree, union)
            mark *= 2
    return links


def count(entries: list[Entry], copies: list[int], left: list[int], right: list[int], percent: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Spanning links as of `join`, and for each entry the copies of all entries of the other side (or its own) that link to it."""

    def fold(which: list[int]) -> dict[int, list[int]]:
        """Entries equal in all their members, under the first of them."""
        first: dict[tuple, int] = {}
        out: dict[int, list[int]] = {}
        for i in which:
            e = entries[i]
            out.setdefault(first.setdefault(tuple(e.tokens), i) if len(e.tokens) == e.size else i, []).append(i)
        return out

    alone = left == right
    held = fold(left)
    asked = held if alone else fold(right)
    weight = {q: sum(copies[i] for i in which) for side in (held, asked) for q, which in side.items()}
    found, links, union = [0] * len(entries), [], Union(len(entries))
    tree = build(entries, list(held), percent)
    for q in asked:
        for i in search(tree, entries, q, percent):
            found[q] += weight[i]
            if not alone:
                found[i] += weight[q]
            if union.join(q, i):
                links.append((q, i))
    n = [0] * len(entries)
    for side in (held,) if alone else (held, asked):
        for q, which in side.items():
            for i in which:
                n[i] = found[q] + (weight[q] - copies[i] if alone else 0)
                if alone and i != q:
                    links.append((q, i))
    return links, n
