"""Where could long windows repeat? Anchors place equal windows under equal keys.

Each window of `window` symbols takes as its anchor the least-hashed gram of `gram` symbols that starts in it and fits.
That choice sees nothing but the window, so that equal windows have equal anchors at equal offsets. Consecutive windows
with one anchor form a span; spans whose key (the anchor gram's hash) is alone in the corpus repeat nowhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Symbols hashed at a time; a longer document goes in parts whose windows join seamlessly.
PART = 1 << 20
#: Bits, as a power of two, that a filter has at most. Beyond 2^26 keys it lets more of the others through: more rows move, none is lost.
MOST_BITS = 30

_KEY, _SPAN = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_powers: dict = {}


def powers(base: int, n: int):
    """(base^i, base^-i) for i up to at least n, modulo 2^64."""
    import numpy as np

    if base not in _powers or len(_powers[base][0]) <= n:
        size = max(n + 1, 1 << 14)
        with np.errstate(over="ignore"):
            both = np.array([[base], [pow(base, -1, 1 << 64)]], dtype=np.uint64).repeat(size, axis=1)
            both[:, 0] = 1
            _powers[base] = tuple(np.cumprod(both, axis=1, dtype=np.uint64))
    return _powers[base]


def sums(symbols, base: int):
    """Prefix sums from which range_hash takes the hash of any range of symbols (uint64, none of them zero)."""
    import numpy as np

    s = np.zeros(len(symbols) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(symbols * powers(base, len(symbols))[0][: len(symbols)], out=s[1:])
    return s


def range_hash(s, a, b, base: int):
    import numpy as np

    with np.errstate(over="ignore"):
        return (s[b] - s[a]) * powers(base, len(s))[1][a]


def _mix(h):
    import numpy as np

    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(symbols, window: int, gram: int, reach: int | None = None):
    """(key, span hash, first window, end of windows, end of symbols) arrays, one row a span, in order.

    The hash is of the symbols from the first window to `reach` symbols (a window, if not given) from the last one's start, as far
    as there are any. Symbols are positive uint64.
    """
    import numpy as np

    reach, count = reach or window, len(symbols) - window + 1
    found = [_part(symbols[a : a + PART + reach - 1], a, min(PART, count - a), window, gram, reach) for a in range(0, max(0, count), PART)]
    if not found:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _part(x, base: int, count: int, window: int, gram: int, reach: int):
    import numpy as np

    s, s2 = sums(x, _KEY), sums(x, _SPAN)
    starts = np.arange(len(x) - gram + 1)
    h = range_hash(s, starts, starts + gram, _KEY)
    low = np.uint64((1 << 24) - 1)
    v = (_mix(h) & ~low) | starts.astype(np.uint64)  # ties go to the first
    width = window - gram + 1
    grid = np.concatenate((v, np.full(-len(v) % width, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    end = np.concatenate((first[1:], [count]))
    stop = np.minimum(end + reach - 1, len(x))
    span = range_hash(s2, first, stop, _SPAN)
    return h[at[first]].view(np.int64), span.view(np.int64), first + base, end + base, stop + base


def xxhash(keys):
    """F.xxhash64 of longs, as uint64."""
    import numpy as np

    one, two, three, four, five = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = (np.uint64(42) + five + np.uint64(8)) ^ (turn(keys.view(np.uint64) * two, 31) * one)
        h = turn(h, 27) * one + four
        h = (h ^ (h >> np.uint64(33))) * two
        h = (h ^ (h >> np.uint64(29))) * three
    return h ^ (h >> np.uint64(32))


class Filter:
    """A bitmap of longs: it may hold others too, but misses none. It has 16 bits or more a key, up to MOST_BITS (128 MB)."""

    def __init__(self, keys: DataFrame, key: Column, count: int):
        """key: a long column of keys, which has about `count` rows."""
        import numpy as np

        self.shift = 64 - min(MOST_BITS, max(15, math.ceil(math.log2(16 * max(1, count)))))
        bit = F.shiftrightunsigned(F.xxhash64(key.cast("long")), self.shift) + 1
        parts = keys.select(F.bitmap_bucket_number(bit).alias("b"), F.bitmap_bit_position(bit).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
        self.bits = np.zeros(1 << (61 - self.shift), dtype=np.uint8)
        for r in parts.toLocalIterator():
            self.bits[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(r.bits, dtype=np.uint8)


def in_filter(held: Filter, keys):
    """Which of the int64 keys the filter may hold."""
    import numpy as np

    at = xxhash(keys) >> np.uint64(held.shift)
    return (held.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def first_half(tid: str = "tid") -> Column:
    """The first eight bytes of a text id as a long, the least byte first."""
    return F.conv(F.concat(*(F.hex(F.substring(tid, i, 1)) for i in range(8, 0, -1))), 16, -10).cast("long")


def row_ids(text_id: int, doc: int, keys, first):
    """int64 names of a document's spans, for the filters."""
    import numpy as np

    with np.errstate(over="ignore"):
        seed = np.uint64(text_id & 0xFFFFFFFFFFFFFFFF) ^ _mix(np.uint64(doc & 0xFFFFFFFFFFFFFFFF))
        return _mix(seed ^ _mix(keys.view(np.uint64) + np.uint64(_KEY) * first.astype(np.uint64))).view(np.int64)


def merge(starts, ends):
    """Disjoint ascending intervals that cover the same as [start, end) do; touching ones join."""
    import numpy as np

    order = np.argsort(starts, kind="stable")
    a, b = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    new = np.concatenate(([True], a[1:] > b[:-1])) if len(a) else np.zeros(0, bool)
    return a[new], np.concatenate((b[:-1][new[1:]], b[-1:])) if len(a) else b
