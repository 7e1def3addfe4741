"""A compressed FM-index over rows of symbols, searched many patterns at a time.

The Burrows-Wheeler transform of the rows lies in a Huffman-shaped wavelet tree:
one bit vector per level with counts per 64-bit word, so a symbol costs about its
entropy in bits.  Backward search extends a match to the left by two ranks.  From
it come a pattern's matching statistics: for every position, the length of the
longest match that starts there (up to ``cap``), and for full ones the first
place in the rows where that stretch occurs.
"""

from __future__ import annotations

import numpy as np

_MASKS = np.array([(1 << k) - 1 for k in range(64)], np.uint64)


def huffman_lengths(freq: np.ndarray) -> np.ndarray:
    """Code lengths of symbols with these (positive) frequencies."""
    n = len(freq)
    if n == 1:
        return np.ones(1, np.int64)
    order = np.argsort(freq, kind="stable")
    weight = freq[order].tolist() + [0] * (n - 1)
    parent = [0] * (2 * n - 1)
    leaf, inner = 0, n  # the two queues: leaves by weight, made nodes by age
    for new in range(n, 2 * n - 1):
        total = 0
        for _ in range(2):
            if leaf < n and (inner >= new or weight[leaf] <= weight[inner]):
                pick, leaf = leaf, leaf + 1
            else:
                pick, inner = inner, inner + 1
            total += weight[pick]
            parent[pick] = new
        weight[new] = total
    depth = [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[parent[node]] + 1
    out = np.empty(n, np.int64)
    out[order] = depth[:n]
    return out


class WaveletTree:
    """rank(c, i): how often symbol c stands among the first i of a sequence."""

    def __init__(self, seq: np.ndarray, sigma: int):
        freq = np.bincount(seq, minlength=sigma)
        used = np.flatnonzero(freq)
        length = np.zeros(sigma, np.int64)
        length[used] = huffman_lengths(freq[used])
        deepest = int(length.max()) if len(used) else 0
        # canonical codes: symbols by (length, symbol) take consecutive codes
        order = used[np.argsort(length[used], kind="stable")]
        steps = np.left_shift(np.int64(1), deepest - length[order])
        code = np.zeros(sigma, np.int64)
        code[order] = (np.cumsum(steps) - steps) >> (deepest - length[order])
        self.length, self.code, self.levels = length, code, []
        s = seq
        for level in range(deepest):
            # the node of each symbol that goes on: symbols of one prefix are
            # neighbours in code order, and so are their places on this level
            go = order[length[order] > level]
            size = np.cumsum(freq[go]) - freq[go]
            prefix = code[go] >> (length[go] - level)
            head = np.concatenate([[True], prefix[1:] != prefix[:-1]]) if len(go) else np.zeros(0, bool)
            start = np.zeros(sigma, np.int64)
            start[go] = size[head][np.cumsum(head) - 1] if len(go) else 0
            bit = ((code[s] >> (length[s] - level - 1)) & 1).astype(np.uint8)
            ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            packed = np.zeros((len(s) // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view("<u8")
            count = np.bitwise_count(words).astype(np.int64)
            before = np.zeros(sigma, np.int64)
            before[go] = ones[start[go]]
            self.levels.append((words, np.cumsum(count) - count, start, before))
            # stable partition of every node: zeros, then ones
            at, own = start[s], ones[:-1] - before[s]
            rank0 = np.arange(len(s)) - at - own
            last = np.concatenate([np.flatnonzero(np.diff(at)), [len(s) - 1]]) if len(s) else np.zeros(0, np.int64)
            zeros = np.zeros(len(s) + 1, np.int64)
            zeros[at[last]] = (rank0 + (1 - bit))[last]
            place = at + np.where(bit == 1, zeros[at] + own, rank0)
            nxt = np.empty_like(s)
            nxt[place] = s
            s = nxt[length[nxt] > level + 1]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        pos = i.astype(np.int64)
        length, code = self.length[c], self.code[c]
        live = np.arange(len(pos))
        for level, (words, count, start, before) in enumerate(self.levels):
            live = live[length[live] > level]
            if not len(live):
                break
            sym, p = c[live], pos[live]
            at = start[sym] + p
            w = at >> 6
            one = count[w] + np.bitwise_count(words[w] & _MASKS[at & 63]) - before[sym]
            bit = (code[live] >> (length[live] - level - 1)) & 1
            pos[live] = np.where(bit == 1, one, p - one)
        return pos


def suffix_order(text: np.ndarray, rank: np.ndarray, longest: int) -> np.ndarray:
    """The suffixes in order, by doubling; ``rank``: first order of the symbols,
    in which every separator is its own."""
    n = len(text)
    k = 1
    order = np.argsort(rank, kind="stable")
    while k <= longest:
        nxt = np.zeros(n, np.int64)
        nxt[:-k or None] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            break
        k *= 2
    return order


class FMIndex:
    """Index of ``rows`` (arrays of symbols 1 .. sigma-1), in the order given."""

    def __init__(self, rows: list[np.ndarray], sigma: int, cap: int):
        sizes = np.array([len(r) for r in rows], np.int64)
        ends = np.cumsum(sizes + 1)
        text = np.zeros(int(ends[-1]) if len(rows) else 0, np.int64)
        #: where each row begins in the text
        self.begins = ends - sizes - 1
        for b, r in zip(self.begins.tolist(), rows):
            text[b : b + len(r)] = r
        n, self.cap = len(text), cap
        mark = text == 0
        rank = text + len(rows)
        rank[mark] = np.arange(int(mark.sum()))
        self.order = suffix_order(text, rank, int(sizes.max()) + 1 if len(rows) else 0)
        self.tree = WaveletTree(text[self.order - 1], sigma)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:sigma]
        # common prefix, up to cap, of each suffix with the one before it
        padded = np.concatenate([text, np.zeros(cap, np.int64)])
        self.common = np.zeros(n, np.int64)
        same = np.arange(1, n)
        for d in range(cap):
            x = padded[self.order[same] + d]
            same = same[(x == padded[self.order[same - 1] + d]) & (x != 0)]
            if not len(same):
                break
            self.common[same] += 1
        self.n = n
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        begin = np.flatnonzero(self.common < cap)
        #: the first place of every stretch of length cap, per suffix
        self.first = np.repeat(np.minimum.reduceat(self.order, begin), np.diff(np.append(begin, n))) if n else np.zeros(0, np.int64)

    def block(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the run of suffixes that agree in ``depth`` symbols."""
        if depth not in self._blocks:
            begin = np.flatnonzero(self.common < depth) if depth else np.zeros(1, np.int64)
            size = np.diff(np.append(begin, self.n))
            self._blocks[depth] = np.repeat(begin, size), np.repeat(begin + size, size)
        return self._blocks[depth]

    def matching_statistics(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For the patterns, one after another: length of the longest match
        (up to cap) that starts at each position, and the first place in the
        text of each that has length cap (-1 for the others).  Symbols that the
        index lacks are given as 0."""
        flat = np.concatenate(patterns) if patterns else np.zeros(0, np.int64)
        size = np.array([len(p) for p in patterns], np.int64)
        stop = np.cumsum(size)
        begin, at = stop - size, stop - 1  # at: the position to extend to
        length, first = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        got = np.zeros(len(size), np.int64)
        live = np.flatnonzero(size > 0)
        while len(live):
            c = flat[at[live]]
            r = self.tree.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]])) + np.tile(self.before[c], 2)
            x, y = r[: len(live)], r[len(live) :]
            ok = (x < y) & (c != 0)
            won = live[ok]
            lo[won], hi[won] = x[ok], y[ok]
            got[won] += 1
            over = won[got[won] > self.cap]
            if len(over):  # drop what is beyond cap: all suffixes of these cap symbols
                b, e = self.block(self.cap)
                lo[over], hi[over] = b[lo[over]], e[lo[over]]
                got[over] = self.cap
            length[at[won]] = got[won]
            full = won[got[won] == self.cap]
            first[at[full]] = self.first[lo[full]]
            at[won] -= 1
            # no match: drop symbols on the right until more suffixes agree
            lost = live[~ok]
            void = lost[(got[lost] == 0) | (flat[at[lost]] == 0)]
            got[void], lo[void], hi[void] = 0, 0, self.n
            at[void] -= 1
            short = lost[(got[lost] > 0)]
            if len(short):
                right = np.where(hi[short] < self.n, self.common[np.minimum(hi[short], self.n - 1)], 0)
                depth = np.minimum(np.maximum(self.common[lo[short]], right), got[short] - 1)
                for d in np.unique(depth).tolist():
                    some = short[depth == d]
                    b, e = self.block(d)
                    lo[some], hi[some] = b[lo[some]], e[lo[some]]
                    got[some] = d
            live = live[at[live] >= begin[live]]
        return length, first
