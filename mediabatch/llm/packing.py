"""Packing by first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents.

Each document is tokenised where it lies. Its ids, an end id behind them, are cut into whole sequences and one remainder;
only (document, start, length, checksum) go on, not the ids. Remainders are dealt to groups by a hash, so that a group has
about `GROUP` pieces whatever the source or length they come from, and each group is packed by itself: lengths in
descending order, each into the first sequence with room, found in a tournament tree over the sequences' free space.

The tokenizer sees chunks between spaces and line breaks, kept in a bounded cache of the worker: its rules never join
across those, and special strings hold none. Defined cases: a null text is empty and still gives its end id; repeated rows and null ids
are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import light_batches, releasing, stored, whole_text, worker_state

SEQUENCE = 2048
END_ID = 1
GROUP = 8192
# A run of signs beside letters is a token of its own. Not so an apostrophe before letters, and `<` may open a special string.
BEHIND = string.punctuation
BEFORE = BEHIND.replace("'", "").replace("<", "")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Ids of texts as little-endian bytes, 4 each.

    Chunks between spaces or line breaks are looked up. Of an unknown one, punctuation before and behind a word is
    looked up apart; unknown words are encoded in bulk, joined by spaces, each one ending with a token that ends words, so that
    the ids can be cut apart again; all else one by one. ASCII capitals are lowered first where that changes no id.

    The look-up has two halves of `limit` / 2 chunks: when the newer is full, the older goes, and what is met again moves on.
    """

    def __init__(self, path: str, limit: int = 1 << 19, longest: int = 12, group: int = 1000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.own = Tokenizer.from_file(path)
        # The same merges for words of small ASCII letters, which the tokenizer's rules neither change nor cut.
        self.plain = Tokenizer(self.own.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.limit, self.longest, self.group = limit, longest, group
        vocabulary = self.own.get_vocab(with_added_tokens=False)
        self.final = np.zeros(self.own.get_vocab_size() + 1, bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _bulk(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isascii()]
        self._learn_by(self.plain, plain)
        self._learn_by(self.own, [w for w in words if not w.isascii()] if len(plain) < len(words) else [])

    def _learn_by(self, tokenizer, words: list[str]) -> None:
        for at in range(0, len(words), self.group):
            some = words[at : at + self.group]
            joined = " ".join(some)
            joined = joined.lower() if tokenizer is self.plain else joined
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) == len(some):
                cuts = [0, *(4 * ends).tolist()]
                whole = ids.tobytes()
                self.known.update((w, whole[i:j]) for w, i, j in zip(some, cuts, cuts[1:], strict=False))
            else:
                self.known.update((w, x.tobytes()) for w, x in zip(some, self._bulk(some), strict=True))

    def _unknown(self, chunks: set[str]) -> set[str]:
        """Those not in the look-up; what its older half holds is moved to the newer."""
        unknown = chunks.difference(self.known)
        again = unknown & self.older.keys()
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        return unknown - again

    def _prepare(self, unknown: set[str]) -> list[str]:
        """Looks the chunks up and returns what is too long to be kept: long words seldom come again."""
        words = {c for c in unknown if c.isascii() and c.isalpha()}
        parts, marks, other = [], set(), []
        for chunk in unknown - words:
            rest = chunk.lstrip(BEFORE)
            body = rest.rstrip(BEHIND)
            # Letters that stay letters.
            if body and (body.isalpha() if body.isascii() else unicodedata.normalize("NFC", body).lower().isalpha()):
                if body == chunk:
                    words.add(body)
                    continue
                head, tail = chunk[: len(chunk) - len(rest)], rest[len(body) :]
                parts.append((chunk, head, body, tail))
                marks.update((head, tail))
            else:
                other.append(chunk)
        bodies = self._unknown({body for _, _, body, _ in parts})
        words |= bodies
        self._learn(list(words))
        other += self._unknown(marks).difference(other)
        known = self.known
        known.update((c, x.tobytes()) for c, x in zip(other, self._bulk(other), strict=True))
        known.update((c, known[head] + known[body] + known[tail]) for c, head, body, tail in parts)
        return [w for some in (unknown, bodies) for w in some if len(w) > self.longest]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [lowered(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > self.limit // 2:
            self.known, self.older = {"": b""}, self.known
        unknown = self._unknown(set().union(*cut))
        long = self._prepare(unknown) if unknown else []
        out = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        for word in long:
            self.known.pop(word, None)
        return out


def lowered(text: str) -> str:
    """`text` with ASCII capitals lowered, as the tokenizer does after composing characters and finding special strings; a text
    where either could see a difference stays as it is."""
    if "<|" in text:
        return text
    if text.isascii():
        return text.lower()
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    composed = unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower)
    return lower if composed else text


def runs(texts: list[str], size: int = 1 << 19) -> Iterator[list[str]]:
    """The texts in runs of about `size` characters."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """A row per piece: each document's ids cut at multiples of `sequence`."""

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = worker_state("packing", f"ids:{tokenizer_path}", lambda: Encoder(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = iter(batch["doc_id"])
            for run in runs(batch["text"].tolist()):
                out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
                for ids in own.encode(run):
                    ids += end
                    doc_id, total = next(doc_ids), len(ids) // 4
                    for start in range(0, total, sequence):
                        part = ids[4 * start : 4 * (start + sequence)]
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        out["doc_tokens"].append(total)
                yield pd.DataFrame(out)

    # Ids travel as strings: pandas has no missing whole numbers.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    made = rows.mapInPandas(releasing(cut), PIECES.replace("doc_id long", "doc_id string"))
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given (descending) order.

    The tree's leaves are the bins' free space, each inner node the larger of its two; the walk from the root goes left
    whenever the left side has room, which ends at the first bin that fits.
    """
    leaves = 1 << max(0, int(len(lengths) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= n
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left >= right else right
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, group_size: int = GROUP) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    with light_batches(docs.sparkSession):
        cut = stored(pieces(docs, tokenizer_path, sequence), "pieces")
    cut = cut.withColumn("row", F.monotonically_increasing_id())
    whole = cut.filter(F.col("length") == sequence)
    rest = cut.filter(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // group_size))

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "row"], ascending=[False, True])
        bins, offsets = first_fit(part["length"].to_numpy(), sequence)
        sequence_id = (part["pack"].to_numpy().astype(np.int64) << 32) | bins
        return part.drop(columns=["row", "pack"]).assign(sequence_id=sequence_id, offset=offsets)

    schema = f"{PIECES}, sequence_id long, offset long".replace("doc_id long", "doc_id string")
    packed = (
        rest.withColumn("doc_id", F.col("doc_id").cast("string"))
        .withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        .groupBy("pack")
        .applyInPandas(place, schema)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
    # Full pieces are sequences of their own; negative ids keep them apart from the packed ones.
    alone = whole.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long")).drop("row")
    return packed.unionByName(alone)
