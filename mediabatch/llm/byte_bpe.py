"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of at most `CHUNK` characters is encoded where it lies. A longer one is cut into chunks that reach `OVERLAP` characters into
their successor; they are dealt to tasks and pre-tokenised side by side, each as if a pre-token began at its start. Where
the boundaries of two neighbours meet inside the overlap both go on alike, for a match depends on nothing before it: there
they are stitched, if the characters on both sides are of different classes to the encoder itself (libraries know
different versions of Unicode) and the first is neither white space, which is divided by what follows it, nor an apostrophe.
Neighbours without such a boundary (a pre-token longer than the overlap) become one chunk, and only such are looked at
again, until all seams are closed. The pieces between seams hold whole pre-tokens, so each is encoded by itself, again
dealt to tasks. Decoding concatenates the bytes of the ids, piece by piece.

Long texts are written once as numbered slices with a key of their own; chunks and seams are light rows, and a task holds a
chunk, or a pre-token that is longer. Short texts are not shuffled.

Defined cases: a null text is empty and has no ids; special strings are ordinary text; repeated rows and null ids are documents
of their own; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import stored, stretches, whole_text, worker_state

CHUNK = 1 << 16
OVERLAP = 1 << 10
SLICES = 64
# The library's matcher gives up on some million blanks in a row; runs of this many are pre-tokens made here.
BLANKS = 100_000
BLANK_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{BLANKS},}}")

SPAN = "key long, first long, last long"
PIECES = "key long, doc_id string, piece long, pieces long, ids array<int>"


def encoding(path: str):
    """The library's encoder for a file of ranks, without special tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def text_ids(own, text: str) -> list[int]:
    """The text's ids. Of a very long run of blanks, all but the last before a text are one pre-token."""
    out, at = [], 0
    for run in BLANK_RUN.finditer(text) if len(text) >= BLANKS else ():
        out += own.encode_ordinary(text[at : run.start()])
        at = run.end() if run.end() == len(text) else run.end() - 1
        out += own._encode_single_piece(text[run.start() : at])
    return out + own.encode_ordinary(text[at:])


def encoder(path: str):
    return worker_state("bytes", f"encoding:{path}", lambda: encoding(path))


def coded(path: str, texts: list[str], decoded: bool) -> dict[str, pa.Array]:
    """The ids of texts and, if wanted, the bytes that these stand for."""
    own = encoder(path)
    ids = [text_ids(own, t) for t in texts]
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
    out = {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}
    if decoded:
        out["bytes"] = pa.array([own.decode_bytes(x) for x in ids], pa.binary())
    return out


class Classes(dict):
    """The encoder's classes of characters: the sign among `SIGNS` that a character shares a pre-token with.

    Asked of the library itself, with ranks that merge one of the signs with any first byte behind it.
    """

    SIGNS = "a1!\n"

    def __init__(self):
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([s, b]): 256 * i + b for i, s in enumerate(self.SIGNS.encode(), 1) for b in range(256)}
        self.probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, character: str) -> str:
        own = [s for s in self.SIGNS if self.probe.encode_ordinary(s + character)[0] >= 256]
        self[character] = own[0] if len(own) == 1 else character
        return self[character]


def boundaries(text: str, *windows: tuple[int, int]) -> list[np.ndarray]:
    """Ends of the pre-tokens of `text`, and its start, that lie in each window and may be stitched at."""
    import regex

    own = worker_state("bytes", "pattern", lambda: regex.compile(public_tokenizers.PATTERN))
    classes = worker_state("bytes", "classes", Classes)
    ends = np.array([0, *(m.end() for m in own.finditer(text))], np.int64)

    def certain(end: int) -> bool:
        if not 0 < end < len(text):
            return not end
        before = classes[text[end - 1]]
        return before not in ("\n", classes[text[end]]) and text[end - 1] != "'"

    return [np.array([e for e in ends[(ends >= a) & (ends < b)].tolist() if certain(e)], np.int64) for a, b in windows]


def slices_of(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The long texts as (key, doc_id, slice, slices, text), each slice with its overlap, as a stored table."""

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, doc_id, text in batch.itertuples(index=False):
                starts = range(0, len(text), chunk)
                for at in range(0, len(starts), SLICES):
                    some = starts[at : at + SLICES]
                    own = pd.DataFrame({"slice": range(at, at + len(some))})
                    own["text"] = [text[s : s + chunk + overlap] for s in some]
                    yield own.assign(key=key, doc_id=pd.Series([doc_id] * len(some), dtype=object), slices=len(starts))

    long = docs.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "text")
    made = long.mapInPandas(cut, "key long, doc_id string, slice long, slices long, text string")
    return stored(made.repartition("key", "slice"), "slices")


def spanned(spans: DataFrame, slices: DataFrame) -> DataFrame:
    """The slices of each span (key, first, last, ...) of neighbouring slices."""
    touched = spans.withColumn("slice", F.explode(F.sequence("first", "last")))
    return touched.join(slices.select("key", "slice", "text"), ["key", "slice"])


def joined(group: pd.DataFrame, chunk: int) -> str:
    """A span's text, with the overlap behind its last slice."""
    texts = group.sort_values("slice")["text"].tolist()
    return "".join([*(t[:chunk] for t in texts[:-1]), texts[-1]])


def seams(slices: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The pieces of the long texts as spans of slices: key, first, last, `start` in the first and `end` (null: the text's end)
    in the slice after the last. A stored table."""

    def ends(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [around(t, chunk) for t in batch["text"]]
            yield batch.drop(columns="text").assign(head=[h for h, _ in both], tail=[t for _, t in both])

    def around(text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries in the overlap with the chunk before, and in that with the next one."""
        head, tail = boundaries(text, (0, overlap), (size, size + overlap))
        return head, tail - size

    def again(group: pd.DataFrame) -> pd.DataFrame:
        head, tail = around(joined(group, chunk), chunk * len(group))
        return group.head(1)[["key", "first", "last"]].assign(head=[head], tail=[tail])

    schema = f"{SPAN}, head array<long>, tail array<long>"
    light = slices.select("key", F.col("slice").alias("first"), F.col("slice").alias("last"), "text")
    chunks = stored(light.mapInPandas(ends, schema), "chunks")
    order = Window.partitionBy("key").orderBy("first")
    while True:
        start = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
        met = chunks.withColumn("start", F.when(F.col("first") == 0, 0).otherwise(start))
        grouped = stored(met.withColumn("span", F.count("start").over(order)), "seams")
        if grouped.filter("start IS NULL").isEmpty():
            return grouped.select("key", "first", "last", "start", F.lead("start").over(order).alias("end"))
        spans = grouped.groupBy("key", "span").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("n"), F.min_by("head", "first").alias("head"),
            F.min_by("tail", "first").alias("tail"),
        )
        spans = stored(spans, "spans")
        merged = spanned(spans.filter("n > 1").select("key", "first", "last"), slices)
        chunks = stored(
            spans.filter("n = 1").select("key", "first", "last", "head", "tail")
            .unionByName(merged.groupBy("key", "first").applyInPandas(again, schema)),
            "chunks",
        )


def coded_parts(docs: DataFrame, path: str, chunk: int, overlap: int, decoded: bool) -> tuple[DataFrame, DataFrame | None]:
    """The pieces of the short texts and those of the long ones, if there are any."""
    # Ids travel as strings: pandas has no missing whole numbers.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    schema = f"{PIECES}, bytes binary" if decoded else PIECES

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for some in stretches(texts):
                n = len(some)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.nulls(n, pa.int64()),
                        "doc_id": batch.column("doc_id").slice(some.start, n),
                        "piece": pa.array(np.zeros(n, np.int64)),
                        "pieces": pa.array(np.ones(n, np.int64)),
                        **coded(path, texts[some.start : some.stop], decoded),
                    }
                )

    def parts(group: pd.DataFrame) -> pd.DataFrame:
        text, own = joined(group, chunk), group.iloc[0]
        end = None if pd.isna(own["end"]) else chunk * len(group) + int(own["end"])
        found = coded(path, [text[int(own["start"]) : end]], decoded)
        place = group.head(1)[["key", "doc_id", "piece", "pieces"]].reset_index(drop=True)
        return place.assign(**{name: column.to_pandas() for name, column in found.items()})

    short = rows.filter(F.char_length("text") <= chunk).mapInArrow(whole, schema)
    slices = slices_of(rows.filter(F.char_length("text") > chunk), chunk, overlap)
    short = short.withColumn("doc_id", F.col("doc_id").cast("long"))
    if slices.isEmpty():
        return short, None
    found = stored(seams(slices, chunk, overlap), "pieces")
    own = Window.partitionBy("key")
    numbered = found.withColumn("piece", F.row_number().over(own.orderBy("first")).cast("long") - 1).withColumn(
        "pieces", F.count("*").over(own)
    )
    named = numbered.join(slices.filter("slice = 0").select("key", "doc_id"), "key")
    long = spanned(named, slices).groupBy("key", "first").applyInPandas(parts, schema)
    return short, long.withColumn("doc_id", F.col("doc_id").cast("long"))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False) -> DataFrame:
    """The texts' ids, by piece: key (null: the text is one piece), doc_id, piece, pieces, ids.

    With `decoded` also the `bytes` that the ids stand for, without sending them to another task.
    """
    short, long = coded_parts(docs, path, chunk, overlap, decoded)
    return short if long is None else short.unionByName(long)


def decode(pieces: DataFrame, path: str) -> DataFrame:
    """`pieces` with the bytes that its ids stand for."""

    @F.pandas_udf("binary")
    def content(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([encoder(path).decode_bytes(ids.tolist()) for ids in batch], dtype=object)

    return pieces.withColumn("bytes", content("ids"))


def texts(short: DataFrame, long: DataFrame | None) -> DataFrame:
    """Per document of decoded pieces: doc_id, its ids and its bytes, the pieces of long texts in order."""
    alone = short.select("doc_id", "ids", "bytes")
    if long is None:
        return alone
    parts = F.array_sort(F.collect_list(F.struct("piece", "ids", "bytes")))
    several = long.groupBy("key").agg(F.first("doc_id").alias("doc_id"), parts.alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    content = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["bytes"])), ""))
    return alone.unionByName(several.select("doc_id", ids.alias("ids"), content.alias("bytes")))


def round_trip(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encodes and decodes: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    found = texts(*coded_parts(docs, path, chunk, overlap, decoded=True))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
