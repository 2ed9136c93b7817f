"""Periodic runs in word sequences, found by multi-scale minimizers.

A run is a stretch of words with smallest period q that is at least `LEAST` words and `REPEATS` * q long and that no neighbour
extends. Periods up to `SHORT` are found by a direct scan at each lag. Longer ones are found by scale: the scale of gram
size g (a power of two) is for the periods in (g/2, g]. There a gram of g words occurs once in each period, and a window of
g/2 grams is shorter than a period, so a window's least gram (by hash) comes again exactly q words on, is the least of its own
window, and has no equal between. Per scale the pairs of neighbouring equal minimizers at a distance in (g/2, g] are
the seeds; each is extended, word by word, both ways at that lag, once per stretch. Hashes only propose: words decide.

The texts of a batch are laid end to end with words between them that equal nothing, so scans and minimizers are numpy
passes over all of them; a scale holds only texts long enough for it. A text is worked on where it lies: no shuffle.

Defined cases: a null text has no words; words are what lies between `[\\x20\\x09-\\x0D]`; repeated rows and null ids are
documents of their own (a null id is never planted); an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import stretches, whole_text

LEAST, REPEATS = 6, 4
SHORT = 8
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def words_of(text: str) -> list[bytes]:
    """The text's words in UTF-8: bytes are split at exactly the six ASCII white spaces."""
    return text.encode("utf-8", "surrogatepass").split()


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each window of `width` values, by running extremes from both ends of blocks of that width."""
    if width == 1:
        return values
    n = len(values)
    blocks = -(-n // width)
    padded = np.concatenate([values, np.full(blocks * width - n, values[-1])]).reshape(blocks, width)
    forward = pick.accumulate(padded, axis=1).ravel()
    backward = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(backward[: n - width + 1], forward[width - 1 : n])


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least gram of some window. Equal least grams of a window are all kept."""
    if len(grams) <= width:
        return np.flatnonzero(grams == grams.min()) if len(grams) else np.zeros(0, np.int64)
    least = sliding(grams, width, np.minimum)
    ends = np.zeros(width - 1, grams.dtype)
    return np.flatnonzero(sliding(np.concatenate([ends, least, ends]), width, np.maximum) == grams)


def primitive(flat: np.ndarray, start: int, period: int) -> bool:
    """Whether the repeated word at `start` is no power of a shorter one. The stretch is at least two periods long."""
    left, factor = period, 2
    while left > 1:
        if factor * factor > left:
            factor = left
        if left % factor == 0:
            shift = period // factor
            if np.array_equal(flat[start : start + period], flat[start + shift : start + shift + period]):
                return False
            while left % factor == 0:
                left //= factor
        factor += 1
    return True


def reach(flat: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on (step 1) or before it (-1) equal the word `lag` further, looked at in growing blocks."""
    size, total = 32, 0
    while True:
        if step > 0:
            a, b = flat[at + total : at + total + size], flat[at + lag + total : at + lag + total + size]
            a = a[: len(b)]
        else:
            low = max(0, at - total - size)
            a, b = flat[low : at - total][::-1], flat[low + lag : at + lag - total][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total += len(a)
        if len(a) < size:
            return total
        size *= 2


def scanned(flat: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Starts and lengths of the stretches of period `lag` that are long enough, by a scan of all places."""
    if len(flat) <= lag:
        return
    equal = np.concatenate([[False], flat[lag:] == flat[:-lag], [False]])
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + lag
    for i in np.flatnonzero(lengths >= max(LEAST, REPEATS * lag)):
        yield int(starts[i]), int(lengths[i])


def seeded(flat: np.ndarray, gram: int) -> Iterator[Run]:
    """The stretches (start, length, lag) that this scale's neighbouring equal minimizers lead to."""
    grams, size = stirred(flat.view(np.uint64) * GOLDEN), 1
    while size < gram:
        grams = stirred(grams[:-size] * GOLDEN + (grams[size:] ^ (grams[size:] >> np.uint64(29))))
        size *= 2
    places = minimizers(grams, gram // 2)
    order = np.lexsort((places, grams[places]))
    places, own = places[order], grams[places[order]]
    lags = places[1:] - places[:-1]
    seeds = np.flatnonzero((own[1:] == own[:-1]) & (lags > gram // 2) & (lags <= gram))
    starts, lags = places[seeds], lags[seeds]
    order = np.lexsort((starts, lags))
    lag, end = 0, 0
    for at, own_lag in zip(starts[order].tolist(), lags[order].tolist(), strict=True):
        if own_lag != lag:
            lag, end = own_lag, 0
        if at < end:  # inside the stretch that was extended last
            continue
        right = reach(flat, at, lag, 1)
        end = at + right
        left = reach(flat, at, lag, -1)
        if right + left + lag >= max(LEAST, REPEATS * lag):
            yield at - left, right + left + lag, lag


def laid_out(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences end to end, each followed by a word that equals no other; and where each starts."""
    sizes = np.array([len(s) + 1 for s in sequences])
    flat = np.empty(sizes.sum(), np.int64)
    starts = np.cumsum(sizes) - sizes
    for start, s in zip(starts.tolist(), sequences, strict=True):
        flat[start : start + len(s)] = s
    flat[starts + sizes - 1] = -1 - np.arange(len(sequences))
    return flat, starts


def find_runs(sequences: list[np.ndarray]) -> list[list[Run]]:
    """Per sequence of non-negative word numbers its runs (start, length, period), by start, then period."""
    out: list[list[Run]] = [[] for _ in sequences]

    def keep(flat: np.ndarray, starts: np.ndarray, numbers: list[int], start: int, length: int, period: int) -> None:
        if primitive(flat, start, period):
            i = int(np.searchsorted(starts, start, "right")) - 1
            out[numbers[i]].append((start - int(starts[i]), length, period))

    numbers = [i for i, s in enumerate(sequences) if len(s) >= LEAST]
    if not numbers:
        return out
    flat, starts = laid_out([sequences[i] for i in numbers])
    for lag in range(1, SHORT + 1):
        for start, length in scanned(flat, lag):
            keep(flat, starts, numbers, start, length, lag)
    gram = 2 * SHORT
    while numbers:
        least = REPEATS * (gram // 2 + 1)
        longer = [i for i in numbers if len(sequences[i]) >= least]
        if len(longer) < len(numbers):
            numbers = longer
            if not numbers:
                break
            flat, starts = laid_out([sequences[i] for i in numbers])
        for start, length, lag in seeded(flat, gram):
            keep(flat, starts, numbers, start, length, lag)
        gram *= 2
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: of each run the first period only."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def planted(words: list, doc_id: str | None) -> list:
    """The words with the period that the document's id asks for, if any."""
    n = len(words)
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RESULT = "doc_id string, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, its runs (start, length, period) and the text that is left with one period of each.

    `plant` first rewrites a tenth of the documents, chosen by their id, with a period of their own, as a test of recall.
    """

    def detect(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for some in stretches(texts):
                words = [words_of(texts[i]) for i in some]
                if plant:
                    words = [planted(w, ids[i]) for i, w in zip(some, words, strict=True)]
                codes, _ = pd.factorize(np.array([x for w in words for x in w] or [b""], object))
                cuts = np.cumsum([len(w) for w in words])[:-1]
                found = find_runs(np.split(codes[: sum(map(len, words))].astype(np.int64), cuts))
                left = []
                for w, runs in zip(words, found, strict=True):
                    own = [x for x, k in zip(w, kept_words(len(w), runs).tolist(), strict=True) if k] if runs else w
                    left.append(b" ".join(own).decode("utf-8", "surrogatepass"))
                yield pd.DataFrame(
                    {
                        "doc_id": [ids[i] for i in some],
                        "n_words": [len(w) for w in words],
                        "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found],
                        "collapsed": left,
                    }
                )

    # Ids travel as strings: pandas has no missing whole numbers.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(detect, RESULT).withColumn("doc_id", F.col("doc_id").cast("long"))


def digests(found: DataFrame) -> DataFrame:
    """Per document of `periodic_runs`: the longest run, its exponent, and digests of the runs and of the text left."""
    # The greatest length, then the smallest start and period: all as one ascending order.
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, F.lit("")).otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.short")).alias("length"),
        F.col("top.period").alias("period"),
        F.expr("(-1000 * top.short) div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def run_digests(docs: DataFrame) -> DataFrame:
    """The planted documents' runs, as digests."""
    return digests(periodic_runs(docs, plant=True))

