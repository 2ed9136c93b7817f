"""Texts cut into words and signs, known by 64-bit hashes, in numpy; and arrays of n-grams as rows dealt by key."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from mediabatch.llm.common import ROW, worker_state
from mediabatch.llm.quality_lm import pieces

# Scripts without spaces: Thai, Lao, Burmese, Khmer, kana, Han.
ALONE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
UNIT = re.compile(rf"[{ALONE}]|[^\W{ALONE}]+|[^\w\s]")
SPACE, WORD, SIGN = 0, 1, 2
BASE = 0x9E3779B97F4A7C15
# Characters that are cut at once, so that their arrays stay in the cache; n-grams that are sorted and sent together.
CUT, RUN = 1 << 16, 1 << 20
BLOCK = "bucket int, kind int, data binary"


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def edges() -> np.ndarray:
    """The units before a text's first and behind its last one."""
    return mix(np.array([1, 2], np.uint64), np.array([3, 4], np.uint64))


class Letters:
    """What each code point is, and a random number for it (none for spaces); the powers of the base and of its inverse."""

    def __init__(self, size: int = 4 * CUT):
        every = "".join(map(chr, range(0x110000)))
        self.kind = np.full(len(every), SPACE, np.uint8)
        for kind, pattern in ((SIGN, r"\S+"), (WORD, rf"[^\W{ALONE}]+")):
            for found in re.finditer(pattern, every):
                self.kind[found.start() : found.end()] = kind
        points = np.arange(len(every), dtype=np.uint64)
        self.number = np.where(self.kind == SPACE, np.uint64(0), mix(points, points + np.uint64(1)))
        self.size, self.made = size, self._made(size)

    @staticmethod
    def _made(size: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(BASE, -1, 1 << 64)
        return tuple(np.multiply.accumulate(np.full(size, np.uint64(x))) for x in (BASE, inverse))

    def powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        return self.made if size <= self.size else self._made(size)


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' units one after another, each text's behind two edges and before an end; and how many each text has.

    The units are the matches of `UNIT`, found for all texts at once by what neighbouring characters are.
    """
    letters = worker_state("words", "letters", Letters)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.intp)
    kind = letters.kind.take(codes)
    first = kind != SPACE
    first[1:] &= (kind[1:] == SIGN) | (kind[:-1] != WORD)
    at = np.flatnonzero(first)
    starts = np.cumsum(lengths + 1) - lengths - 1
    counts = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    edge, end = edges()
    units = np.full(len(at) + 3 * len(texts), edge)
    if len(at):
        power, inverse = letters.powers(len(codes))
        sums = letters.number.take(codes)
        sums *= power[: len(codes)]
        sums = np.append(np.cumsum(sums, out=sums), sums[-1])
        ends = np.append(at[1:] - 1, len(codes))
        found = np.diff(sums[ends], prepend=sums[at[0] - 1] if at[0] else np.uint64(0)) * inverse[at]
        units[np.arange(len(at)) + np.repeat(3 * np.arange(len(texts)) + 2, counts)] = mix(found, found)
    units[np.cumsum(counts + 3) - 1] = end
    return units, counts + 3


def places(texts: list[str], share: int = 0, shares: int = 1) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Of each unit that stands behind one of the share: it and the two before it, and the number of its text; and how many
    units each text has with its end."""
    w, sizes = encode(texts)
    inside = np.ones(len(w), bool)
    starts = np.cumsum(sizes) - sizes
    inside[starts] = inside[starts + 1] = False
    if shares > 1:
        inside[1:] &= w[:-1] % np.uint64(shares) == share
    at = np.flatnonzero(inside)
    return (w[at - 2], w[at - 1], w[at]), np.repeat(np.arange(len(texts)), sizes)[at], sizes - 2


def trigrams(texts: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    (w1, w2, w3), owner, _ = places(texts)
    return {"g3": mix(mix(w1, w2), w3), "w1": w1, "w2": w2, "w3": w3}, owner


def runs(batches: Iterable[pd.DataFrame], share: int, shares: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row keys, numbers of units, the share's trigrams (w1, w2, w3) and their texts' places among the rows, about `RUN` at a time."""
    held, first, size = [], 0, 0
    for batch in batches:
        keys = batch[ROW].to_numpy(np.int64)
        for start, run in pieces(batch["text"].tolist(), CUT):
            found, owner, units = places(run, share, shares)
            held.append((keys[start : start + len(run)], units, *found, owner + first))
            first, size = first + len(run), size + len(owner)
            if size >= RUN:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, first, size = [], 0, 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def stepped(x: np.ndarray) -> np.ndarray:
    """Longs as the bytes of their differences, place by place: sorted keys take fewer bytes so."""
    return np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(-1, 8).T.copy()


def unstepped(steps: np.ndarray, kind: type = np.uint64) -> np.ndarray:
    return np.cumsum(steps.T.copy().view(kind)[:, 0], dtype=kind)


def packed(*arrays: np.ndarray) -> bytes:
    data = pickle.dumps(arrays, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))


def blocks(
    kind: int, groups: int, key: np.ndarray, shared: list[np.ndarray], own: list[np.ndarray], *extra: np.ndarray, keyed: bool = True
) -> pd.DataFrame:
    """Entries dealt by key over `groups` buckets, one row a bucket: the different keys, if they are sent, how many entries each
    has, what a key's entries share, what each has of its own, and `extra` in every row."""
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(at, len(key))).astype(np.uint32)
    keys = key[at]
    shared, own = [x[order[at]] for x in shared], [x[order] for x in own]
    # Buckets are ranges of keys.
    bucket = (keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
    cuts = np.searchsorted(bucket, np.arange(groups + 1, dtype=np.uint64))
    ends = np.append(at, len(key))[cuts]
    rows = []
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
        k, e = slice(cuts[i], cuts[i + 1]), slice(ends[i], ends[i + 1])
        data = packed(stepped(keys[k] if keyed else keys[:0]), counts[k], *(x[k] for x in shared), *(x[e] for x in own), *extra)
        rows.append((int(i), kind, data))
    return pd.DataFrame(rows, columns=["bucket", "kind", "data"])


def joined(data: list[bytes], shared: int) -> list[np.ndarray]:
    """The entries of several rows of `blocks`: key, then every column with one value for each entry. Keys that were not sent
    are those of the first two shared columns."""
    parts = []
    for own in data:
        steps, counts, *columns = unpacked(own)
        keys = unstepped(steps) if steps.size else mix(*columns[:2])
        parts.append([np.repeat(keys, counts), *(np.repeat(x, counts) for x in columns[:shared]), *columns[shared:]])
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key its place among the known ones, which are sorted, and whether it is there.

    Keys are hashes: their leading bits tell about where they are, most within a step or two.
    """
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    bits = len(known).bit_length()
    shift = np.uint64(64 - bits)
    begins = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << shift)
    at = np.minimum(begins.take((keys >> shift).view(np.int64)), len(known) - 1)
    behind = np.flatnonzero(known.take(at) < keys)
    while len(behind):
        at[behind] += 1
        behind = behind[at[behind] < len(known)]
        behind = behind[known.take(at[behind]) < keys[behind]]
    at = np.minimum(at, len(known) - 1)
    return at, known.take(at) == keys
