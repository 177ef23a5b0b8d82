"""Byte-pair merges compiled into a lazily determinised finite-state transducer.

After a prefix of the input the merges leave one last token, and what they make of the prefix is what they make of the part
before that token, with the token behind it. A token may follow another if the merges keep the two apart when they are
written together. So reading a symbol means: of the tokens that end here, take the one that may follow the last token
before it. A state holds the places at which a token can still be under way: for each its node in the trie of tokens, the
last token before it, and the number of tokens before it beyond those that all places share. What all share is settled:
the transition is annotated with the number of tokens settled by it, and the delay is at most the longest token. The ids
themselves are read back from the last tokens of the states passed.

States and transitions are made when an input first needs them, kept in tables, and dropped all together when there are
more than ``max_states``, as lazy automata do; later inputs make those they need again.

Symbols are small integers; a token is a string of characters with those numbers.
"""

from __future__ import annotations

import numpy as np

MAX_STATES = 250_000
#: Inputs up to this length run side by side, one symbol of each at a time; longer ones run alone.
LANE = 48
NEVER = 1 << 60
_SHIFT = 9


class MergeTransducer:
    """``tokens``: token to id. ``merges``: pairs of ids to (rank, id of the merged token), lowest rank first.

    A pair must have a higher rank than the merges that make its two tokens, as in every trained vocabulary.
    """

    def __init__(self, tokens: dict[str, int], merges: dict[tuple[int, int], tuple[int, int]], max_states: int = MAX_STATES):
        self.merges, self.max_states = merges, max_states
        self.single = {t: i for t, i in tokens.items() if len(t) == 1}
        self.split: dict[int, tuple[int, int, int]] = {}
        texts = {i: t for t, i in tokens.items()}
        self.size: dict[int, int] = {}
        self.child: list[dict[int, int] | None] = [{}]
        self.token: list[int | None] = [None]
        for i in sorted({m[1] for m in merges.values()} | set(self.single.values()), key=lambda i: len(texts[i])):
            t = texts[i]
            ids = self.merged([self.single.get(c, -1) for c in t], 2)
            if len(ids) == 2:
                if (tuple(ids) not in merges) or merges[ids[0], ids[1]][1] != i:
                    continue  # no input gives this token
                self.split[i] = (merges[ids[0], ids[1]][0], ids[0], ids[1])
            elif ids != [i]:
                continue
            node = 0
            for c in map(ord, t):
                if self.child[node] is None:
                    self.child[node] = {}
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append(None)
                    self.token.append(None)
                node = self.child[node][c]
            self.token[node], self.size[i] = i, len(t)
        self.clear()

    def clear(self) -> None:
        start = ((0, None, 0),)
        self.states, self.number, self.step = [start], {start: 0}, {}
        self.last, self.rest, self.last_array = [0], [0], np.zeros(0, np.int32)
        self.keys, self.to, self.out = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.apart: dict[tuple[int, int], bool] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}

    def merged(self, ids: list[int], until: int = 1) -> list[int]:
        """The merges applied one after another, lowest rank and then leftmost first, down to ``until`` tokens."""
        ids, get = list(ids), self.merges.get
        while len(ids) > until:
            rank, k = min((get((a, b), (NEVER,))[0], k) for k, (a, b) in enumerate(zip(ids, ids[1:])))
            if rank == NEVER:
                break
            ids[k:k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def _edge(self, token: int, side: int, kept: dict) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is merged: (token, rank of the merge that ends it), in time."""
        got = kept.get(token)
        if got is None:
            got, t = [(token, NEVER)], token
            while t in self.split:
                rank, t = self.split[t][0], self.split[t][side]
                got.append((t, rank))
            kept[token] = got = got[::-1]
        return got

    def may_follow(self, a: int | None, b: int) -> bool:
        """Whether no merge crosses from a to b: no two edge tokens that stand side by side merge before one of them ends."""
        if a is None:
            return True
        known = self.apart.get((a, b))
        if known is None:
            x, y, i, j, known = self._edge(a, 2, self.right), self._edge(b, 1, self.left), 0, 0, True
            while True:
                (s, s_end), (t, t_end) = x[i], y[j]
                m = self.merges.get((s, t))
                if m is not None and m[0] < s_end and m[0] <= t_end:
                    known = False
                    break
                if s_end == t_end == NEVER:
                    break
                if s_end <= t_end:
                    i += 1
                else:
                    j += 1
            self.apart[a, b] = known
        return known

    def _make(self, state: int, symbol: int) -> tuple[int, int]:
        child, token = self.child, self.token
        places, here = [], None
        for node, last, n in self.states[state]:
            to = child[node].get(symbol)
            if to is None:
                continue
            t = token[to]
            if here is None and t is not None and self.may_follow(last, t):
                here = (0, t, n + 1)
            if child[to]:
                places.append((to, last, n))
        places.append(here)
        settled = min(p[2] for p in places)
        new = tuple((node, last, n - settled) for node, last, n in places)
        k = self.number.get(new)
        if k is None:
            k = self.number[new] = len(self.states)
            self.states.append(new)
            self.last.append(new[-1][1])
            self.rest.append(new[-1][2])
        return k, settled

    def _alone(self, symbols: bytes, end: int) -> tuple[int, list[int]]:
        """(number of tokens, last token behind each symbol) of one input."""
        state, total, step, last, trace = 0, 0, self.step, self.last, []
        for c in (*symbols[:-1], symbols[-1] + end):
            got = step.get(state << _SHIFT | c)
            if got is None:
                got = step[state << _SHIFT | c] = self._make(state, c)
            state, n = got
            total += n
            trace.append(last[state])
        return total + self.rest[state], trace

    def _last(self) -> np.ndarray:
        """``last`` as an array, kept up with the states."""
        have = self.last_array
        if len(have) < len(self.last):
            self.last_array = have = np.concatenate([have, np.array(self.last[len(have):], np.int32)])
        return have

    def _known(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state reached, tokens settled) of transitions; those not in the table are made and added."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            miss = self.keys[at] != key
        else:
            miss = np.ones(len(key), bool)
        if miss.any():
            new = np.unique(key[miss])
            made = np.array([self._make(k >> _SHIFT, k & (1 << _SHIFT) - 1) for k in new.tolist()], np.int32)
            where = np.searchsorted(self.keys, new)
            self.keys, self.to, self.out = (np.insert(x, where, y) for x, y in zip((self.keys, self.to, self.out), (new, *made.T)))
            at = np.searchsorted(self.keys, key)
        return self.to[at], self.out[at]

    def _run(self, data: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each input, last token behind each symbol). ``data`` holds the inputs one after another."""
        if len(self.states) > self.max_states:
            self.clear()
        start = np.cumsum(size) - size
        total, trace = np.zeros(len(size), np.int64), np.zeros(len(data), np.int32)
        lanes = np.flatnonzero((size > 0) & (size <= LANE))
        lanes = lanes[np.argsort(-size[lanes], kind="stable")]
        n, first = size[lanes], start[lanes]
        state, sums = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), np.int64)
        for j in range(int(n[0]) if len(n) else 0):
            k = int(np.searchsorted(-n, -j))  # lanes longer than j
            symbol = data[first[:k] + j].astype(np.int64)
            symbol[n[:k] == j + 1] += end
            state[:k], out = self._known(state[:k] << _SHIFT | symbol)
            sums[:k] += out
            trace[first[:k] + j] = self._last()[state[:k]]
        total[lanes] = sums + np.array(self.rest, np.int64)[state]
        for i in np.flatnonzero(size > LANE).tolist():
            a = int(start[i])
            total[i], trace[a:a + int(size[i])] = self._alone(data[a:a + int(size[i])].tobytes(), end)
        return total, trace

    def count(self, data: np.ndarray, size: np.ndarray, end: int = 0) -> np.ndarray:
        """Number of tokens of each input; ``end`` is added to the last symbol of each."""
        return self._run(data, size, end)[0]

    def ids(self, data: np.ndarray, size: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all inputs one after another, tokens per input): last tokens, read from the end of each input."""
        total, trace = self._run(data, size, end)
        length = np.zeros(max(self.size) + 1, np.int64)
        length[list(self.size)] = list(self.size.values())
        out = np.zeros(int(total.sum()), np.uint32)
        at, start = np.cumsum(total) - 1, np.cumsum(size) - size
        left, lane = size.copy(), np.flatnonzero(size > 0)
        while len(lane):
            t = trace[start[lane] + left[lane] - 1]
            out[at[lane]] = t
            at[lane] -= 1
            left[lane] -= length[t]
            lane = lane[left[lane] > 0]
        return out, total


def rank_merges(tokens: dict[str, int]) -> dict[tuple[int, int], tuple[int, int]]:
    """Merges of a vocabulary of ranks: two tokens merge if their concatenation is one, at its rank."""
    out = {}
    for t, i in tokens.items():
        for k in range(1, len(t)):
            a, b = tokens.get(t[:k]), tokens.get(t[k:])
            if a is not None and b is not None:
                out[a, b] = (i, i)
    return out
