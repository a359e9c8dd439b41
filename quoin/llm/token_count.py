"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .vocabulary import SPACE, vocabulary

#: Words that a Python process remembers, some 150 bytes each; the common ones are met first.
MEMO = 1_000_000


#: Bits of a heap entry that hold the place in the text; the rank is above them.
_PLACE = 32
_AT = (1 << _PLACE) - 1


class Merger:
    """Counts the merges of byte-pair encoding within a run of symbols."""

    def __init__(self, ranks: dict[str, int]) -> None:
        self.ranks = ranks
        self.pairs = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}

    def merges(self, text: str) -> int:
        """Merges made in text: always the adjacent pair of lowest rank, the leftmost of equals.

        Symbols stand in a linked list (`after`, `before`). The heap holds rank and place of a pair
        in one number; `now` has the rank of the pair that begins at each place, so an entry whose
        rank is no longer there is stale and skipped.
        """
        rank = self.ranks.get
        symbols, n = list(text), len(text)
        now = list(map(rank, map(add, text, text[1:])))
        heap = [r << _PLACE | i for i, r in enumerate(now) if r is not None]
        if not heap:
            return 0
        heapify(heap)
        now.append(None)
        after, before, made = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            top = heappop(heap)
            i = top & _AT
            if now[i] != top >> _PLACE:
                continue
            made += 1
            j = after[i]
            pair = symbols[i] = symbols[i] + symbols[j]
            now[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = now[i] = rank(pair + symbols[k])
                if r is not None:
                    heappush(heap, r << _PLACE | i)
            else:
                now[i] = None
            h = before[i]
            if h >= 0:
                r = now[h] = rank(symbols[h] + pair)
                if r is not None:
                    heappush(heap, r << _PLACE | h)
        return made


class Counts(dict):
    """Tokens of a word, worked out when it is first asked for: its symbols, less the merges.

    A character that is no piece is as many symbols as it has bytes. No merge spans two characters
    that are nowhere adjacent within a piece, so a word is cut there and its parts are counted.
    """

    def __init__(self, model: str, prefix: str) -> None:
        v = vocabulary(model)
        self.merger, self.prefix, self.known = Merger(v.ranks), prefix, v.ids
        self.characters = {c for c in v.ids if len(c) == 1}

    def part(self, s: str) -> int:
        symbols = len(s) if self.characters.issuperset(s) else sum(1 if c in self.characters else len(c.encode()) for c in s)
        return symbols - self.merger.merges(s)

    def __missing__(self, word: str) -> int:
        s, pairs = self.prefix + word, self.merger.pairs
        if pairs.issuperset(map(add, s, s[1:])):
            total = self.part(s)
        else:
            total, at = 0, 0
            for i in range(1, len(s) + 1):
                if i == len(s) or s[i - 1 : i + 1] not in pairs:
                    total += self.part(s[at:i])
                    at = i
        if len(word) <= 64 and len(self) < MEMO:
            self[word] = total
        return total


@lru_cache(maxsize=4)
def counters(model: str) -> tuple[Counts, Counts]:
    return Counts(model, SPACE), Counts(model, "")


def count_tokens(text: str, model: str) -> int:
    """Tokens of a text, with the space that the model puts before it; the empty text has none.

    Words are cut apart before each space that follows no other; no piece spans such a place.
    A line break is no piece, so lines are cut apart too, at one token for each break.
    """
    if not text:
        return 0
    spaced, bare = counters(model)
    if "\n" in spaced.known:
        return spaced[text.replace(" ", SPACE)]
    total, lead = 0, spaced
    for n, line in enumerate(text.replace(SPACE, " ").split("\n")):
        if "  " in line or line[:1] == " " or line[-1:] == " ":
            total += _runs(line, lead, bare)
        else:
            words = line.split(" ")
            total += lead[words[0]] + sum(map(spaced.__getitem__, words[1:]))
        total += n > 0
        lead = bare
    return total


def _runs(line: str, lead: Counts, bare: Counts) -> int:
    """Tokens of a line with runs of spaces: a run belongs to the word that follows."""
    whole, total, at = lead.prefix + line.replace(" ", SPACE), 0, 0
    for i in range(1, len(whole) + 1):
        if i == len(whole) or whole[i] == SPACE and whole[i - 1] != SPACE:
            total += bare[whole[at:i]]
            at = i
    return total


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs, in one pass without a shuffle.

    Counts equal those of the library for the model, without begin and end tokens; special names
    within a text are plain text. Null and empty texts have no bytes and no tokens. Texts of any
    length are counted whole; a word of any length takes a time that grows as n log n. Repeated rows
    each get their count, and an empty table gives an empty one. Other columns, of whatever name,
    are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in tk.parts(batch, 1)):
            n_bytes = pc.binary_length(part.column(1)).fill_null(0).cast(pa.int64())
            n_tokens = [count_tokens(t.as_py() or "", model) for t in part.column(1)]
            yield pa.record_batch([part.column(0), n_bytes, pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
