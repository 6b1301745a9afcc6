"""A run-length index: run-compressed Burrows-Wheeler transform, samples at run ends, matching statistics.

Texts stand one after the other, each closed by a separator; separators sort before all bytes and among each other by
text. Suffixes are sorted up to a text's end, the transform is cut into runs of one symbol, and only the first and last
row of each run keep their text position. Queries stream from right to left, many side by side: if the row's symbol is
the query's, the row steps by LF; else it jumps to the nearest run of that symbol above or below, whichever keeps the
longer match, whose length the sampled position gives by comparing with the text.
"""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a long; ``data`` has eight bytes more than places."""
    return np.ndarray((len(data) - 8,), "<u8", data.tobytes(), strides=(1,))


class RunLengthIndex:
    """Over texts given flat: ``data`` their bytes, one after the other, ``sizes`` their lengths."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, depth: int):
        """depth: matches of so many bytes are told apart by interval."""
        self.depth, m = depth, len(sizes)
        ends = np.cumsum(sizes + 1)
        n = int(ends[-1]) if m else 0
        sym = np.zeros(n + 16, np.int64)
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        sym[:n][inside] = data.astype(np.int64) + 1
        self.text = np.repeat(np.arange(m), sizes + 1)
        self.starts = ends - sizes - 1
        self.left = np.repeat(ends, sizes + 1) - np.arange(n)  # symbols up to and with the separator
        # suffix order by doubling, up to each text's end
        key, alive = sym[:n].copy(), sym[:n] != 0
        for j in range(1, 7):
            s = sym[j : n + j] * alive
            key = (key << 9) | s
            alive &= s != 0
        rank, h, longest = self._dense(key), 7, int(sizes.max(initial=0)) + 1
        while h < longest and n and int(rank.max()) + 1 < n:
            ahead = np.zeros(n, np.int64)
            far = np.nonzero(self.left > h)[0]
            ahead[far] = rank[far + h] + 1
            rank, h = self._dense(rank * np.int64(n + 1) + ahead), 2 * h
        sa = np.argsort(rank * np.int64(max(n, 1)) + np.arange(n))
        before = sym[sa - 1]
        before[self.left[sa] == (sizes + 1)[self.text[sa]]] = 0
        cut = np.ones(n, bool)
        cut[1:] = before[1:] != before[:-1]
        self.run_start = np.nonzero(cut)[0]
        self.run_head = before[self.run_start]
        run_size = np.diff(np.append(self.run_start, n))
        self.last_row = self.run_start + run_size - 1
        self.first_sample, self.last_sample = sa[self.run_start], sa[self.last_row]
        # occurrences of a run's symbol before it, and where the symbol's rows begin
        by = np.argsort(self.run_head, kind="stable")
        total = np.cumsum(run_size[by]) - run_size[by]
        head = self.run_head[by]
        first = np.searchsorted(head, head)
        self.run_rank = np.empty(len(by), np.int64)
        self.run_rank[by] = total - total[first] if len(by) else total
        self.smaller = np.searchsorted(np.sort(before), np.arange(258))
        # runs of each symbol in order, for jumps
        self.jump_key = head * np.int64(len(by) + 1) + by
        self.jump_run = by
        # the sampled texts as words, for the length of a jump's match
        padded = np.zeros(n + 24, np.uint8)
        padded[:n][inside] = data
        self.words = words_at(padded)
        self.n = n
        self._intervals(sa)

    @staticmethod
    def _dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        s = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.append(False, s[1:] != s[:-1])) if len(key) else 0
        return rank

    def _intervals(self, sa: np.ndarray) -> None:
        """Rows whose suffixes share their first ``depth`` bytes: interval bounds, with the texts' least per owner later."""
        long = self.left[sa] > self.depth
        same = np.zeros(len(sa), bool)
        at = np.nonzero(long[1:] & long[:-1])[0] + 1
        a, b = sa[at], sa[at - 1]
        equal = np.ones(len(at), bool)
        for o in [*range(0, self.depth - 7, 8), self.depth - 8]:
            equal &= self.words[a + o] == self.words[b + o]
        same[at] = equal
        self.interval_start = np.nonzero(~same)[0]
        self.interval_texts = self.text[sa]

    def least_owner(self, owner: np.ndarray) -> np.ndarray:
        """For each interval the least owner of a text in it."""
        return np.minimum.reduceat(owner[self.interval_texts], self.interval_start)

    def match_length(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes the texts share from places a and b on, up to ``most`` and the ends of both."""
        room = np.minimum(most, np.minimum(self.left[a], self.left[b]) - 1)
        got = np.zeros(len(a), np.int64)
        open_ = np.nonzero(room > 0)[0]
        while len(open_):
            x = self.words[a[open_] + got[open_]] ^ self.words[b[open_] + got[open_]]
            low = x & (~x + np.uint64(1))
            step = np.where(x == 0, 8, (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64))
            got[open_] += step
            open_ = open_[(step == 8) & (got[open_] < room[open_])]
        return np.minimum(got, room)

    def matching_statistics(self, data: np.ndarray, sizes: np.ndarray):
        """For queries given flat: (length, row) at every place; the longest match that begins there with any text.

        The row is one whose suffix begins with that match.
        """
        m, total = len(sizes), int(sizes.sum())
        length, row_at = np.zeros(total, np.int64), np.zeros(total, np.int64)
        ends = np.cumsum(sizes)
        by = np.argsort(-sizes, kind="stable")
        row, place, have = np.zeros(m, np.int64), np.full(m, self.first_sample[0] if self.n else 0, np.int64), np.zeros(m, np.int64)
        runs = len(self.run_start)
        for step in range(int(sizes.max(initial=0)) if self.n else 0):
            q = by[: np.searchsorted(-sizes[by], -step, side="left")]
            at = ends[q] - 1 - step
            c = data[at].astype(np.int64) + 1
            run = np.searchsorted(self.run_start, row[q], side="right") - 1
            miss = np.nonzero(self.run_head[run] != c)[0]
            if len(miss):
                qm, cm = q[miss], c[miss]
                k = np.searchsorted(self.jump_key, cm * np.int64(runs + 1) + run[miss])
                lo, hi = k - 1, k
                has_lo = (lo >= 0) & (self.run_head[self.jump_run[np.maximum(lo, 0)]] == cm)
                has_hi = (hi < runs) & (self.run_head[self.jump_run[np.minimum(hi, runs - 1)]] == cm)
                up, down = self.jump_run[np.maximum(lo, 0)], self.jump_run[np.minimum(hi, runs - 1)]
                l_up = np.where(has_lo, self.match_length(place[qm], self.last_sample[up], have[qm]), -1)
                l_down = np.where(has_hi, self.match_length(place[qm], self.first_sample[down], have[qm]), -1)
                use_up = l_up >= l_down
                found = np.maximum(l_up, l_down)
                run[miss] = np.where(found < 0, run[miss], np.where(use_up, up, down))
                row[qm] = np.where(found < 0, 0, np.where(use_up, self.last_row[up], self.run_start[down]))
                place[qm] = np.where(found < 0, self.first_sample[0], np.where(use_up, self.last_sample[up], self.first_sample[down]))
                have[qm] = found
            ok = have[q] >= 0
            g, r = q[ok], run[ok]
            row[g] = self.smaller[c[ok]] + self.run_rank[r] + row[g] - self.run_start[r]
            place[g] -= 1
            have[g] += 1
            have[q[~ok]] = 0
            length[at], row_at[at] = have[q], row[q]
        return length, row_at

    def earlier(self, data: np.ndarray, sizes: np.ndarray, owner: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """At each place of the queries: whether its ``depth`` bytes also stand in a text whose owner is smaller.

        owner: of each query; owners: of each indexed text.
        """
        if not self.n or not len(sizes):
            return np.zeros(int(sizes.sum()), bool)
        length, row = self.matching_statistics(data, sizes)
        out = np.zeros(len(length), bool)
        at = np.nonzero(length >= self.depth)[0]
        interval = np.searchsorted(self.interval_start, row[at], side="right") - 1
        out[at] = self.least_owner(owners)[interval] < np.repeat(owner, sizes)[at]
        return out
