"""Token ids of whole texts, encoding each distinct piece of a block once.

The byte-level vocabulary splits a text before every space that stands between
two characters that are no white space, whatever stands around it, on both sides
of such a line end, and between letters and a mark that ends the piece.  Texts
are therefore cut there, a block of texts at a time and in numpy: the pieces are
told apart by two 64-bit digests, looked up in a bounded table of known pieces,
and the unknown ones are encoded together, in one call of the ``tokenizers``
library for those behind a space and one for the others, and told apart by the
ids that begin with a space or are the line end's.  The ids of all pieces are
then gathered in their order.  When the table is full, the pieces that were met
last stay.  Texts with other white space, or that hold a special string, go to
the library whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

import numpy as np

#: Bound of the table of known pieces of one Python worker.
MEMO_PIECES = 250_000
#: Longest piece, in bytes, that is kept in the table.
MEMO_BYTES = 64
#: Texts are taken in blocks of about this many characters.
BLOCK = 500_000
#: Marks that are cut from the end of a piece of letters.
MARKS = b".,;:!?"


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_ODD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def stretch_digests(raw: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each stretch of ``raw``, which goes on for eight
    bytes behind the last one."""
    size = end - begin
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))  # eight bytes from any place
    one = _mixed(size.astype(np.uint64) * _ODD + _MIX1)
    two = size.astype(np.uint64) * _MIX2 + _ODD
    live = np.arange(len(size))
    for k in range(0, 256, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        part = eight[begin[live] + k] & _HEAD[np.minimum(size[live] - k, 8)]
        one[live] = _mixed((one[live] ^ part) * _ODD)
        two[live] = (two[live] + part) * _MIX2
        two[live] ^= two[live] >> np.uint64(29)
    for i in live[size[live] > 256].tolist():  # very long pieces
        d = hashlib.blake2b(raw[begin[i] : end[i]], digest_size=16).digest()
        one[i], two[i] = int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")
    return one, _mixed(two)


# White space of one byte other than the space and the line end.
_OTHER = np.zeros(256, bool)
_OTHER[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
# Bytes of which letters are made: ASCII letters, and those of U+00C0 to U+00FF
# (their first byte, and second ones; the two signs among them apart).
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = True


def _wide_spaces(b: np.ndarray) -> np.ndarray:
    """Places of white space of two or three bytes."""
    c2 = np.flatnonzero(b == 0xC2)
    out = [c2[np.isin(b[c2 + 1], (0x85, 0xA0))]]
    for lead in (0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(b == lead)
        x, y = b[at + 1].astype(int), b[at + 2].astype(int)
        if lead == 0xE1:
            hit = (x == 0x9A) & (y == 0x80)
        elif lead == 0xE3:
            hit = (x == 0x80) & (y == 0x80)
        else:
            hit = (x == 0x80) & ((y <= 0x8A) | np.isin(y, (0xA8, 0xA9, 0xAF))) | (x == 0x81) & (y == 0x9F)
        out.append(at[hit])
    return np.concatenate(out)


class Encoder:
    """Ids (little-endian unsigned 32-bit) of texts by a byte-level ``tokenizers`` file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.opens = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin with a space
        for s, i in vocab.items():
            self.opens[i] = s.startswith("Ġ")
        self.mark = np.zeros(256, "<u4")  # one more than the id of a mark, where it has one of its own
        for m, ids in zip(MARKS, self.whole([chr(m) for m in MARKS])):
            if len(ids) == 4:
                self.mark[m] = int.from_bytes(ids, "little") + 1
        line = self.whole(["\n"])[0]
        if len(line) != 4:
            raise ValueError(f"{path} has no single id for a line end")
        self.line = int.from_bytes(line, "little")
        # the table: digests in order, and of each piece the other digest, its
        # ids' place in the pool, their number, and the block that met it last
        self.known = self.check = np.zeros(0, np.uint64)
        self.at = self.n = self.met = np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")
        self.blocks = 0

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def ids(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text, as bytes (null: none)."""
        out: list[bytes] = [b""] * len(texts)
        at = 0
        while at < len(texts):
            picked, chars = [], 0
            while at < len(texts) and chars < BLOCK:
                text = texts[at]
                if text:
                    chars += len(text)
                    if any(s in text for s in self.specials):
                        out[at] = self.whole([text])[0]
                    else:
                        picked.append(at)
                at += 1
            if picked:
                for i, found in zip(picked, self._block([texts[i] for i in picked])):
                    out[i] = found
        return out

    def _block(self, texts: list[str]) -> list[bytes]:
        own = [t.encode() for t in texts]
        raw = b" ".join(own) + b" " * 9  # every text has a space behind it
        b = np.frombuffer(raw, np.uint8)
        bounds = np.cumsum([0] + [len(t) + 1 for t in own])
        stop = int(bounds[-1])
        # texts whose only white space is single spaces and line ends, each
        # between two other characters; at an end of a text it meets a space
        blank = (b[:stop] == 0x20) | (b[:stop] == 0x0A)
        bad = np.concatenate([np.flatnonzero(blank[1:] & blank[:-1]), np.flatnonzero(_OTHER[b[:stop]]), _wide_spaces(b)])
        if blank[0]:
            bad = np.append(bad, 0)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(bounds, bad, "right") - 1] = True
        if len(bad):  # the space between two texts may belong to either
            odd[np.minimum(np.searchsorted(bounds, bad + 1, "right") - 1, len(texts) - 1)] = True
        # pieces: what stands between two of these; those of odd texts are passed over
        end = np.flatnonzero(blank)
        begin = np.concatenate([[0], end[:-1] + 1])
        text = np.searchsorted(bounds, begin, "right") - 1
        if odd.any():
            plain = ~odd[text]
            begin, end, text = begin[plain], end[plain], text[plain]
        head = begin == bounds[text]
        line = ~head & (b[np.maximum(begin - 1, 0)] == 0x0A)
        gathered = self._gathered(raw, b, begin, end, head | line, line)
        if gathered is None:  # two pieces of one digest
            return self.whole(texts)
        ids, counts = gathered
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = ends[np.searchsorted(text, np.arange(len(texts)))].tolist()
        last = ends[np.searchsorted(text, np.arange(len(texts)), "right")].tolist()
        data = ids.tobytes()
        out = [data[4 * x : 4 * y] for x, y in zip(first, last)]
        strange = np.flatnonzero(odd).tolist()
        for i, found in zip(strange, self.whole([texts[i] for i in strange]) if strange else ()):
            out[i] = found
        return out

    def _gathered(self, raw: bytes, b: np.ndarray, begin: np.ndarray, end: np.ndarray, bare: np.ndarray, line: np.ndarray):
        """(ids of all pieces in their order, ids per piece); ``bare``: no
        space stands before the piece, ``line``: a line end does."""
        if not len(begin):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        strange = ~_LETTER[b]
        strange[1:] |= (b[:-1] == 0xC3) & ((b[1:] == 0x97) | (b[1:] == 0xB7))
        before = np.concatenate([[0], np.cumsum(strange, dtype=np.int32)])
        mark = self.mark[b[end - 1]]
        cut = (mark > 0) & (end - begin > 1) & (before[end] - before[begin] == 1)
        end = end - cut
        one, two = stretch_digests(raw, begin, end)
        one[bare] = _mixed(one[bare] ^ _MIX2)
        two[bare] = _mixed(two[bare] ^ _MIX1)
        digest, place, piece = np.unique(one, return_index=True, return_inverse=True)
        other = two[place]
        if (two != other[piece]).any():
            return None
        self.blocks += 1
        slot = np.minimum(np.searchsorted(self.known, digest), max(len(self.known) - 1, 0))
        found = self.known[slot] == digest if len(self.known) else np.zeros(len(digest), bool)
        if (self.check[slot[found]] != other[found]).any():
            return None
        at, n = np.zeros(len(digest), np.int64), np.zeros(len(digest), np.int64)
        at[found], n[found] = self.at[slot[found]], self.n[slot[found]]
        self.met[slot[found]] = self.blocks
        new = np.flatnonzero(~found)
        for some, encode in ((new[~bare[place[new]]], self._behind_a_space), (new[bare[place[new]]], self._bare)):
            if not len(some):
                continue
            x, y = begin[place[some]], end[place[some]]
            ids, n[some] = encode([raw[p:q].decode() for p, q in zip(x.tolist(), y.tolist())])
            at[some] = len(self.pool) + np.cumsum(n[some]) - n[some]
            self.pool = np.concatenate([self.pool, ids])
            keep = some[y - x <= MEMO_BYTES]
            into = np.searchsorted(self.known, digest[keep])
            self.known, self.check = np.insert(self.known, into, digest[keep]), np.insert(self.check, into, other[keep])
            self.at, self.n = np.insert(self.at, into, at[keep]), np.insert(self.n, into, n[keep])
            self.met = np.insert(self.met, into, self.blocks)
        counts = n[piece] + line + cut
        ends = np.cumsum(counts)
        # the place in the pool of every id: its piece's, and on; the ids of
        # line ends and marks go into the places left for them
        source = np.repeat((at[piece] - (ends - counts) - line).astype(np.int32), counts)
        source += np.arange(int(ends[-1]), dtype=np.int32)
        ids = self.pool.take(source, mode="clip")
        ids[ends[cut] - 1] = mark[cut] - 1
        ids[(ends - counts)[line]] = self.line
        if len(self.known) > MEMO_PIECES:
            self._shrink()
        return ids, counts

    def _shrink(self) -> None:
        """Keep the half of the table that was met last."""
        stay = np.sort(np.argsort(self.met, kind="stable")[-(MEMO_PIECES // 2) :])
        self.known, self.check, self.met, n = self.known[stay], self.check[stay], self.met[stay], self.n[stay]
        ends = np.cumsum(n)
        self.pool = self.pool[np.repeat(self.at[stay] - (ends - n), n) + np.arange(int(ends[-1]))]
        self.at, self.n = ends - n, n

    def _behind_a_space(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, a space before each, and their numbers."""
        raw = np.frombuffer(self.whole([" " + " ".join(new)])[0], "<u4")
        cuts = np.flatnonzero(self.opens[raw])
        if len(cuts) != len(new):  # a piece that the library doesn't open with its space
            return self._each([" " + p for p in new])
        return raw, np.diff(np.append(cuts, len(raw)))

    def _bare(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same with no space before them."""
        raw = np.frombuffer(self.whole(["\n".join(new)])[0], "<u4")
        cuts = np.flatnonzero(raw == self.line)
        if len(cuts) != len(new) - 1:
            return self._each(new)
        return np.delete(raw, cuts), np.diff(np.concatenate([[-1], cuts, [len(raw)]])) - 1

    def _each(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self.whole(new)
        return np.frombuffer(b"".join(each), "<u4"), np.array([len(x) // 4 for x in each], np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
