"""Similarity of one text to a block of texts at once: bit-parallel common subsequences in numpy, and bounds that make most of them needless."""

from __future__ import annotations

import numpy as np

#: Characters fall into so many groups in the bound; a group's counts bound those of its characters.
GROUPS = 64
#: Texts that are scored at a time.
CHUNK = 128


def _codes(texts: list[str]):
    return [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]


def common_lengths(masks, columns, own: int):
    """Lengths of the longest common subsequences of one text of `own` characters with many others at once.

    masks: for each word of 64 places and each character the places of the text that hold it. columns: the others' characters, first ones first; one without
    places stands for none. Carries go from word to word, so that texts may be of any length.
    """
    count = columns.shape[1]
    rows = np.full((len(masks), count), np.uint64(0xFFFFFFFFFFFFFFFF))
    for column in columns:
        carry = np.zeros(count, dtype=np.uint64)
        for w, mask in enumerate(masks):
            row, here = rows[w], mask[column]
            total = row + (row & here)
            over = total < row
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            rows[w] = total | (row & ~here)
    common = np.zeros(count, dtype=np.int64)
    for w, row in enumerate(rows):
        used = min(64, own - 64 * w)
        if used > 0:
            common += used - np.bitwise_count(row & np.uint64((1 << used) - 1)).astype(np.int64)
    return common


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with any stretch of the longer one of its length, or cut off at either end; of two as long, either way."""
    if len(a) == len(b):
        return max(_best_stretch(a, b), _best_stretch(b, a))
    return _best_stretch(*sorted((a, b), key=len))


def _best_stretch(short: str, long: str) -> float:
    """All stretches in one pass."""
    if not short:
        return 0.0 if long else 100.0
    n, (own, other) = len(short), _codes([short, long])
    alphabet, ids = np.unique(own, return_inverse=True)
    masks = np.zeros((-(-n // 64), len(alphabet) + 1), dtype=np.uint64)
    for i, c in enumerate(ids.tolist()):
        masks[i // 64, c] |= np.uint64(1 << (i % 64))
    at = np.minimum(np.searchsorted(alphabet, other), len(alphabet) - 1)
    known = np.where(alphabet[at] == other, at, len(alphabet))
    padded = np.concatenate((np.full(n - 1, len(alphabet)), known, np.full(n - 1, len(alphabet))))
    columns = np.lib.stride_tricks.sliding_window_view(padded, n).T
    starts = np.arange(1 - n, len(long))
    lengths = np.minimum(starts + n, len(long)) - np.maximum(starts, 0)
    return float((200.0 * common_lengths(masks, columns, n) / (n + lengths)).max())


class TextBlock:
    """A block of texts in an order of preference: of equal scores the earlier one is the better."""

    def __init__(self, texts: list[str]):
        codes = _codes(texts)
        self.texts = texts
        self.length = np.array([len(c) for c in codes], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.uint32), *codes])
        self.alphabet, ids = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), self.length)
        # Padding is a character that no text has.
        self.chars = np.full((len(texts), int(self.length.max(initial=0))), len(self.alphabet), dtype=np.int32)
        self.chars[owner, np.arange(len(flat)) - np.repeat(np.cumsum(self.length) - self.length, self.length)] = ids
        self.groups = np.zeros((GROUPS, len(texts)), dtype=np.int32)
        np.add.at(self.groups, (flat % GROUPS, owner), 1)
        self.scored = 0

    def bounds(self, text: str):
        """For each text of the block the most that its score can be: what its characters' counts have in common."""
        counts = np.bincount(_codes([text])[0] % GROUPS, minlength=GROUPS)
        common = np.zeros(len(self.texts), dtype=np.int64)
        for g in np.flatnonzero(counts):
            common += np.minimum(self.groups[g], counts[g])
        return self._ratio(common, len(text), self.length)

    @staticmethod
    def _ratio(common, own: int, lengths):
        both = lengths + own
        return np.where(both == 0, 100.0, 200.0 * common / np.maximum(both, 1))

    def masks(self, text: str):
        """For each character of the block, and padding, the places of the text that hold it, 64 to a word."""
        codes = _codes([text])[0]
        words = max(1, -(-len(codes) // 64))
        out = np.zeros((words, len(self.alphabet) + 1), dtype=np.uint64)
        at = np.searchsorted(self.alphabet, codes)
        for i in np.flatnonzero((at < len(self.alphabet)) & (self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes)) if len(self.alphabet) else ():
            out[i // 64, at[i]] |= np.uint64(1 << (int(i) % 64))
        return out

    def scores(self, text: str, masks, which):
        """Indel ratios of the text with the block's texts `which`: 200 x longest common subsequence / total length."""
        self.scored += len(which)
        if not len(which):
            return np.zeros(0)
        chars = self.chars[which, : int(self.length[which].max())].T
        common = common_lengths(masks, chars, len(text))
        return self._ratio(common, len(text), self.length[which])

    def nearest(self, text: str, k: int, prefixes):
        """For each of the ascending prefixes, its k best other texts among the block's first so many: a list of (places, scores).

        Candidates are taken in the order of their bounds while these reach the k-th best score. A longer prefix starts from the shorter one's best,
        so that only what is new there and can still get in is looked at.
        """
        bounds = self.bounds(text)
        same = np.array([t == text for t in self.texts], dtype=bool)
        bounds[same] = -1.0
        masks = self.masks(text)
        places, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        out, done = [], 0
        for end in prefixes:
            if end > done:
                least = scores[-1] if len(places) == k else 0.0
                fresh = done + np.flatnonzero(bounds[done:end] >= least)
                fresh = fresh[np.argsort(-bounds[fresh], kind="stable")]
                at = 0
                while at < len(fresh):
                    if len(places) == k and bounds[fresh[at]] < scores[-1]:
                        break
                    part = fresh[at : at + CHUNK]
                    at += len(part)
                    if len(places) == k:
                        part = part[bounds[part] >= scores[-1]]
                    places, scores = np.concatenate((places, part)), np.concatenate((scores, self.scores(text, masks, part)))
                    best = np.lexsort((places, -scores))[:k]
                    places, scores = places[best], scores[best]
                done = end
            out.append((places, scores))
        return out
