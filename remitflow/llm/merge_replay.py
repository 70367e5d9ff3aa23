"""Corpus-level replay of byte-pair merges.

All words of a slice of the corpus lie in one flat token array.  An inverted index maps the rank
of a token pair to the positions where that pair begins.  Ranks are taken in ascending order; each
merge is applied to the whole slice at once and only the neighbours of the merged positions get new
pairs and index entries.  Words are independent, so taking the smallest rank over all words applies
the merges of each word in its own order; of several occurrences in a word only the leftmost is
merged at a time, as the sequential algorithm does.
"""

from __future__ import annotations

import heapq

import numpy as np

_NONE = np.int32(2**31 - 1)


class Merges:
    """Pairs of token ids that merge, with rank and resulting id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, result: np.ndarray):
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        order = np.argsort(key)
        # A last entry that no pair equals keeps searchsorted's answer a valid index.
        self.key = np.append(key[order], np.int64(2**62))
        self.rank = np.append(rank[order].astype(np.int32), _NONE)
        self.result = np.append(result[order].astype(np.int32), 0)
        by_rank = np.argsort(rank, kind="stable")
        self.result_of = dict(zip(rank[by_rank].tolist(), result[by_rank].tolist()))

    @classmethod
    def from_ranks(cls, ranks: dict[bytes, int]) -> Merges:
        """Every split of a token into two tokens; rank and id are the token's rank."""
        parts = [(a, b, r) for word, r in ranks.items() if len(word) > 1 for i in range(1, len(word))
                 if (a := ranks.get(word[:i])) is not None and (b := ranks.get(word[i:])) is not None]
        left, right, rank = (np.array(x, dtype=np.int64) for x in zip(*parts))
        return cls(left, right, rank, rank)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], _NONE)


def replay(tokens: np.ndarray, starts: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Apply ``merges`` to the words ``tokens[starts[i]:starts[i + 1]]``; (ids, starts) of the result."""
    n = len(tokens)
    lengths = np.diff(starts)
    word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    tok = np.append(tokens.astype(np.int32), np.int32(-1))  # position n stands for "no neighbour"
    nxt = np.append(np.arange(1, n + 1, dtype=np.int32), np.int32(n))
    prv = np.append(np.arange(-1, n - 1, dtype=np.int32), np.int32(n))
    filled = lengths > 0
    nxt[starts[1:][filled] - 1] = n
    prv[starts[:-1][filled]] = n
    pair = np.full(n + 1, _NONE, dtype=np.int32)  # rank of the pair that begins here
    alive = np.ones(n, dtype=bool)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
        known = ranks != _NONE
        positions, ranks = positions[known], ranks[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        heads = ranks[np.concatenate(([0], cuts))].tolist()
        for r, part in zip(heads, np.split(positions, cuts) if len(cuts) else (positions,)):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    first = np.flatnonzero(nxt[:n] != n).astype(np.int32)
    pair[first] = merges.ranks_of(tok[first], tok[nxt[first]])
    enter(first, pair[first])
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        at = found[0] if len(found) == 1 else np.concatenate(found)
        at = at[pair[at] == r]
        if not len(at):
            continue
        if len(at) > 1:
            at = np.unique(at)
            later = np.flatnonzero(word[at[1:]] == word[at[:-1]]) + 1
            if len(later):  # of each word the leftmost; the rest waits for its turn
                wait = at[later]
                at = np.delete(at, later)
                index[r] = [wait]
                heapq.heappush(heap, r)
        gone = nxt[at]
        after = nxt[gone]
        tok[at] = merges.result_of[r]
        nxt[at] = after
        prv[after] = at  # position n only takes what nobody reads
        alive[gone] = False
        pair[gone] = _NONE
        before = prv[at]
        before = before[before != n]
        touched = np.concatenate((at, before))
        new = merges.ranks_of(tok[touched], tok[nxt[touched]])
        pair[touched] = new
        enter(touched, new)
    count = np.add.reduceat(np.append(alive, False), starts[:-1]) * filled if len(lengths) else lengths
    return tok[:n][alive], np.concatenate(([0], np.cumsum(count)))
