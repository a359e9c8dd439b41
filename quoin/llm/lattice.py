"""Sampling segmentations from the lattice of a vocabulary's pieces, and decoding them without loss.

A batch of texts is one array of code points. Each text gets a space in front; a space is the
vocabulary's sign for it. Words begin at a space that follows no other; no piece spans such a place,
so the lattice of a text falls into those of its words, and equal words share one. Forward sums are
made once for each distinct word; then every occurrence is cut backwards from its end, by draws that
depend on the row key and the place in the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import exp, log

import numpy as np

from . import textkernel as tk
from .textkernel import U
from .vocabulary import SPACE, vocabulary

_SPACE = ord(SPACE)
#: Stands for a space sign that is in the text itself: it is no piece, so its bytes are written.
_OWN_SIGN = 0x110000
_B = 0x9E3779B97F4A7C55 * 5 + 2
#: Characters of a word after which sums are made one by one, as few words are so long; more than a piece has.
LONG = 256
#: Characters of such a word that are taken at once.
BLOCK = 1 << 16
#: Characters of words whose lattices a process remembers.
MEMO = 1 << 18
#: Words under way below which each is cut by itself.
FEW = 24


@dataclass
class Pieces:
    """A vocabulary as arrays, some 4 MB, so tasks are sent them ready made."""

    longest: int
    slots: np.ndarray  # open hash table of all that pieces begin with; 0 is empty
    number: np.ndarray  # by slot: 1 + the number of the piece that ends so, or 0
    more: np.ndarray  # by slot: whether longer pieces begin so
    ids: np.ndarray  # by number
    weights: np.ndarray  # log weights
    byte_ids: np.ndarray
    data: np.ndarray  # bytes of all pieces, end to end, for decoding
    at: np.ndarray


@dataclass
class Ways:
    """For each character of the distinct words the pieces that end there, longest first."""

    hashes: np.ndarray  # of each word
    base: np.ndarray  # its first character
    size: np.ndarray
    inside: np.ndarray  # by character: its place in the word
    place: np.ndarray  # by character: its first piece below
    many: np.ndarray  # by character: its pieces
    length: np.ndarray
    number: np.ndarray  # -1: no piece, bytes
    share: np.ndarray  # running share of the segmentations that end with this piece or one before; the last is 1


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _hash(codes: np.ndarray) -> int:
    h = 0
    for c in codes.tolist():
        h = (h * _B + c + 1) % (1 << 64)
    return h


@lru_cache(maxsize=4)
def pieces(model: str, alpha: float) -> Pieces:
    """Piece weights fall with the rank of their score: log weight = -alpha * log(1 + rank)."""
    v = vocabulary(model)
    number: dict[int, int] = {}
    more: set[int] = set()
    for n, p in enumerate(v.ids, 1):
        c = _codes(p)
        starts = [_hash(c[:i]) for i in range(1, len(c) + 1)]
        for h in starts[:-1]:
            number.setdefault(h, 0)
            more.add(h)
        if number.get(starts[-1]) or 0 in starts:
            raise ValueError("two pieces have the same hash")
        number[starts[-1]] = n
    bits = (4 * len(number)).bit_length()
    slots, at = np.zeros(1 << bits, dtype=U), []
    for h in number:
        i = _slot(h, bits)
        while slots[i]:
            i = (i + 1) & ((1 << bits) - 1)
        slots[i] = h
        at.append(i)
    by_slot, longer = np.zeros(1 << bits, dtype=np.int32), np.zeros(1 << bits, dtype=bool)
    by_slot[at], longer[at] = list(number.values()), [h in more for h in number]
    names = {i: p.replace(SPACE, " ").encode() for p, i in v.ids.items()} | {b: bytes([n]) for n, b in enumerate(v.bytes_)}
    parts = [names.get(i, b"") for i in range(max(names) + 1)]
    ranks = np.array([v.ranks[p] for p in v.ids], dtype=np.float64)
    return Pieces(max(map(len, v.ids)), slots, by_slot, longer, np.array(list(v.ids.values()), dtype=np.int32), -alpha * np.log1p(1 + ranks),
                  np.array(v.bytes_, dtype=np.int32), np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([0] + [len(p) for p in parts]))


def _slot(h: int, bits: int) -> int:
    return (h * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - bits)


def _find(p: Pieces, asked: np.ndarray) -> np.ndarray:
    """The slot of each hash, -1 where it is missing."""
    out, todo, bits = np.full(len(asked), -1, dtype=np.int64), np.arange(len(asked)), len(p.slots).bit_length() - 1
    slot = ((asked * U(0x9E3779B97F4A7C15)) >> U(64 - bits)).astype(np.int64)
    while len(todo):
        there = p.slots[slot]
        hit = there == asked[todo]
        out[todo[hit]] = slot[hit]
        on = ~hit & (there != 0)
        todo, slot = todo[on], (slot[on] + 1) & (len(p.slots) - 1)
    return out


def _uniform(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (tk.mix(keys + tk.mix(places.astype(U), 41), 42) >> U(11)).astype(np.float64) * 2.0**-53


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct hash, and for every occurrence the number of its hash."""
    seen, _ = tk.tally(hashes)
    number = np.searchsorted(seen, hashes)
    where = np.empty(len(seen), dtype=np.int64)
    where[number] = np.arange(len(hashes))
    return where, number


def sample(texts: list[str], keys: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, end to end, and the offsets of each text's ids.

    P(segmentation) is proportional to the product of its pieces' weights. A character that is no
    piece is written as its bytes.
    """
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    n = int(first[-1])
    if not n:
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    raw = _codes("".join([" " + t for t in texts if t]))
    full = np.flatnonzero(sizes)
    codes = np.where(raw == 32, np.uint32(_SPACE), np.where(raw == _SPACE, np.uint32(_OWN_SIGN), raw))
    space = codes == _SPACE
    head = space & ~np.concatenate(([False], space[:-1]))
    head[first[full]] = True
    starts = np.flatnonzero(head)
    ends = np.append(starts[1:], n)
    hashes = _spans(codes, starts, ends)
    where, number = _distinct(hashes)
    ways, word = _known(hashes[where], codes, starts[where], ends[where], p)

    # backwards from each word's end
    of = full[np.searchsorted(first[full], starts, side="right") - 1]
    spot, state, key, begin = ends - 1, (ways.base + ways.size)[word[number]] - 1, keys[of], first[of]
    ids = np.full(n, -1, dtype=np.int32)
    while len(spot) > FEW:
        draw = _uniform(key, spot - begin)
        e, on = ways.place[state], np.arange(len(spot))
        while len(on):
            on = on[ways.share[e[on]] <= draw[on]]
            e[on] += 1
        length, chosen = ways.length[e], ways.number[e]
        ids[spot - length + 1] = np.where(chosen >= 0, p.ids[chosen], -2)
        on = np.flatnonzero(ways.inside[state] >= length)
        spot, state, key, begin = spot[on] - length[on], state[on] - length[on], key[on], begin[on]
    for i in range(len(spot)):
        at, chosen = _backward(ways, int(state[i]), int(spot[i]), key[i : i + 1], int(begin[i]))
        ids[at] = np.where(chosen >= 0, p.ids[chosen], -2)

    chosen = np.flatnonzero(ids != -1)
    out, width = ids[chosen], np.ones(len(chosen), dtype=np.int64)
    lost = np.flatnonzero(out == -2)
    if len(lost):
        said = [chr(c) if c != _OWN_SIGN else SPACE for c in codes[chosen[lost]].tolist()]
        raw_bytes = [c.encode("utf-8", "surrogatepass") for c in said]
        width[lost] = [len(b) for b in raw_bytes]
        spread = np.repeat(out, width)
        spread[np.repeat(out == -2, width)] = p.byte_ids[np.frombuffer(b"".join(raw_bytes), dtype=np.uint8)]
        out = spread
    before = np.concatenate(([0], np.cumsum(width)))
    return out, before[np.searchsorted(chosen, first)]


_memo: dict[int, tuple[Pieces, Ways]] = {}


def _known(hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: Pieces) -> tuple[Ways, np.ndarray]:
    """The lattices of the given words and of some others, and the place of each given word; sums are made for new words only."""
    have = _memo.get(id(p))
    if have is None or have[0] is not p:
        ways = _lattice(hashes, codes, starts, ends, p)
        word = np.arange(len(hashes))
    else:
        old = have[1]
        order = np.argsort(old.hashes)
        word = tk.lookup(old.hashes[order], (order + 1).astype(np.int64), hashes) - 1
        fresh = np.flatnonzero(word < 0)
        word[fresh] = len(old.hashes) + np.arange(len(fresh))
        ways = _joined(old, _lattice(hashes[fresh], codes, starts[fresh], ends[fresh], p)) if len(fresh) else old
    if len(ways.inside) <= MEMO:
        _memo.clear()
        _memo[id(p)] = (p, ways)
    return ways, word


def _joined(a: Ways, b: Ways) -> Ways:
    both = lambda name: np.concatenate((getattr(a, name), getattr(b, name)))
    return Ways(both("hashes"), np.concatenate((a.base, b.base + len(a.inside))), both("size"), both("inside"), np.concatenate((a.place, b.place + len(a.length))), both("many"), both("length"), both("number"), both("share"))


def _lattice(hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: Pieces) -> Ways:
    """The pieces of the given words, with their shares by forward sums.

    Sums of the first LONG characters run over all words at once, one place after the other; those of
    further characters run word by word. Which way is taken depends on the place alone, so a word's
    shares are the same whatever words it is with.
    """
    size = ends - starts
    base = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(base, size)
    chars = codes[np.repeat(starts, size) + inside].astype(U)
    m = len(chars)
    left = np.repeat(size, size) - inside  # characters from here to the word's end
    h, active, many = np.zeros(m, dtype=U), np.arange(m), np.zeros(m, dtype=np.int64)
    found = []  # (length, last characters, numbers)
    for length in range(1, p.longest + 1):
        active = active[left[active] >= length]
        if not len(active):
            break
        h[active] = h[active] * U(_B % (1 << 64)) + chars[active + length - 1] + U(1)
        slot = _find(p, h[active])
        active, slot = active[slot >= 0], slot[slot >= 0]
        number = p.number[slot]
        found.append((length, active[number > 0] + length - 1, number[number > 0] - 1))
        many[found[-1][1]] += 1
        active = active[p.more[slot]]
        if length == 1:
            bare = np.flatnonzero(many == 0)  # no piece: bytes
            found.append((1, bare, np.full(len(bare), -1)))
            many[bare] += 1
    by_step = np.argsort(inside, kind="stable")
    edge = np.concatenate(([0], np.cumsum(many[by_step])))
    place = np.empty(m, dtype=np.int64)
    place[by_step] = edge[:-1]
    w = Ways(hashes, base, size, inside, place, many, np.empty(edge[-1], dtype=np.int32), np.empty(edge[-1], dtype=np.int32), np.empty(edge[-1]))
    own, free = np.empty(edge[-1], dtype=np.int64), place.copy()
    for length, last, number in reversed(found):
        at = free[last]
        w.length[at], w.number[at], own[at] = length, number, last
        free[last] += 1
    w.share[:] = np.where(w.number >= 0, p.weights[w.number], 0.0)  # log weights, until their sums are known

    total = np.zeros(m)  # log sum of all segmentations of the word up to and with this character
    step = np.concatenate(([0], np.cumsum(np.bincount(inside[inside < LONG], minlength=1))))
    for at, (i, j) in enumerate(zip(step[:-1].tolist(), step[1:].tolist())):
        a, b = int(edge[i]), int(edge[j])
        heads, n = edge[i:j] - a, many[by_step[i:j]]
        x = w.share[a:b] + np.where(w.length[a:b] > at, 0.0, total[own[a:b] - w.length[a:b]])
        peak = np.maximum.reduceat(x, heads)
        x = np.exp(x - np.repeat(peak, n))
        later = np.flatnonzero(n > 1)
        k = 1
        while len(later):
            x[heads[later] + k] += x[heads[later] + k - 1]
            k += 1
            later = later[n[later] > k]
        whole = x[heads + n - 1]
        total[by_step[i:j]] = peak + np.log(whole)
        w.share[a:b] = x / np.repeat(whole, n)
    for word in np.flatnonzero(size > LONG).tolist():
        _forward(w, total, int(base[word]), int(size[word]))
    return w


def _entries(w: Ways, low: int, high: int) -> np.ndarray:
    """Where the pieces of the characters from low to high are."""
    n = w.many[low:high]
    return np.repeat(w.place[low:high] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _forward(w: Ways, total: np.ndarray, base: int, size: int) -> None:
    """Forward sums of a word from its character LONG on, a BLOCK of them at a time."""
    for low in range(base + LONG, base + size, BLOCK):
        high = min(low + BLOCK, base + size)
        at = _entries(w, low, high)
        length, weight, sums, shares, k = w.length[at].tolist(), w.share[at].tolist(), total[low - LONG : low].tolist(), [], 0
        for n in w.many[low:high].tolist():
            if n == 1:
                sums.append(weight[k] + sums[-length[k]])
                shares.append(1.0)
            else:
                x = [weight[i] + sums[-length[i]] for i in range(k, k + n)]
                peak, run, runs = max(x), 0.0, []
                for v in x:
                    run += exp(v - peak)
                    runs.append(run)
                sums.append(peak + log(run))
                shares += [v / run for v in runs]
            k += n
        w.share[at] = shares
        total[low:high] = sums[LONG:]


def _backward(w: Ways, state: int, spot: int, key: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(first characters, numbers) of the pieces of one word that ends at spot, a BLOCK of characters at a time."""
    base, shift = state - int(w.inside[state]), spot - state
    heads, chosen = [], []
    while state >= base:
        low = max(base, state - BLOCK + 1)
        at = _entries(w, low, state + 1)
        length, number, share = w.length[at].tolist(), w.number[at].tolist(), w.share[at].tolist()
        first = np.concatenate(([0], np.cumsum(w.many[low : state + 1]))).tolist()
        places = np.arange(low, state + 1) + (shift - begin)
        draw = _uniform(np.repeat(key, len(places)), places).tolist()
        while state >= low:
            e, d = first[state - low], draw[state - low]
            while share[e] <= d:
                e += 1
            state -= length[e]
            heads.append(state + 1 + shift)
            chosen.append(number[e])
    return np.array(heads, dtype=np.int64), np.array(chosen, dtype=np.int64)


def _spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of codes."""
    out, at = np.empty(len(starts), dtype=U), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + tk.SEGMENT)))
        low, high = int(starts[at]), int(ends[to - 1])
        sums = np.zeros(high - low + 1, dtype=U)
        np.cumsum((codes[low:high].astype(U) + U(1)) * tk.powers(tk._P, high - low), out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = tk.mix((sums[e] - sums[s]) * tk.powers(tk._P_INV, high - low + 1)[s] + (e - s).astype(U), 17)
        at = to
    return out


def decode(ids: np.ndarray, offsets: np.ndarray, p: Pieces) -> list[bytes]:
    """The texts of piece ids, as UTF-8: pieces and bytes end to end, without the space in front."""
    size = (p.at[1:] - p.at[:-1])[ids]
    to = np.cumsum(size)
    raw = p.data[np.repeat(p.at[:-1][ids] - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)].tobytes()
    edge = np.concatenate(([0], to))[offsets].tolist()
    return [raw[a + 1 : b] if b > a else b"" for a, b in zip(edge[:-1], edge[1:])]
