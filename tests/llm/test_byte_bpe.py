import hashlib

import public_tokenizers
import pytest
import regex
from llm.cases import DOCS, awkward, stored_docs, words

from mediabatch.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.encoding(PATH)


def by_hand(rows, encoder):
    out = []
    for doc_id, text, *_ in rows:
        ids = encoder.encode_ordinary(text or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode()))
        out.append((doc_id, len(ids), *digests))
    return sorted(out, key=repr)


def long_texts():
    return [
        (201, "it's we've I'll they'd you're " * 40, "en", "a", 1),
        (202, "ab" + " " * 300 + "cd\n\n\n\nef" * 9, "en", "a", 1),
        (203, "x" * 500 + " y", "en", "a", 1),
        (204, "日本語の文章、" * 60 + "終わり。", "ja", "a", 1),
        (205, "a1b2c3" * 80 + "!?" * 70, "en", "a", 1),
        (206, "<|endoftext|> and " * 20 + "  \x85 é😀" * 30, "en", "a", 1),
        (207, "\n" * 400, "en", "a", 1),
        (208, words(3, 200).replace(" ", "  "), "en", "a", 1),
        (None, words(4, 300), "en", "a", 1),
        (None, words(4, 300), "en", "a", 1),
        (210, "ab\u0558cd, \u0558\u0558" * 90, "hy", "a", 1),
        (209, "'" * 70 + "s' 'll" * 50, "en", "a", 1),
    ]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (40, 40), (97, 24)])
def test_stitched_ids_are_the_librarys(spark, tmp_path, rows_of, encoder, chunk, overlap):
    rows = [r for r in awkward() if len(r[1] or "") < 2_000] + long_texts()
    docs = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    assert rows_of(byte_bpe.round_trip(docs, PATH, chunk, overlap)) == by_hand(rows, encoder)
    encoded = byte_bpe.encode(docs, PATH, chunk, overlap)
    assert encoded.filter("doc_id = 204 AND pieces > 3").count() > 3
    assert encoded.filter("doc_id = 203").count() < 500 // chunk


def test_whole_tables(spark, tmp_path, rows_of, encoder):
    rows = [*awkward(), *long_texts(), (300, words(9, 30_000), "en", "a", 1), (301, "z" * 70_000 + " end", "en", "a", 1)]
    docs = stored_docs(spark, tmp_path / "d", rows)
    assert rows_of(byte_bpe.round_trip(docs, PATH)) == by_hand(rows, encoder)
    empty = spark.createDataFrame([], DOCS)
    assert byte_bpe.round_trip(empty, PATH).count() == 0


def test_pieces_are_whole_pre_tokens(spark, tmp_path, encoder):
    text = words(5, 2_000) + "\n\n 12 x" * 50
    docs = stored_docs(spark, tmp_path / "d", [(1, text, "en", "a", 1)])
    encoded = byte_bpe.encode(docs, PATH, 512, 64, decoded=True).withColumnRenamed("bytes", "at_once")
    pieces = byte_bpe.decode(encoded, PATH).orderBy("piece").collect()
    assert all(p["at_once"] == p["bytes"] for p in pieces)
    assert len(pieces) > 10
    assert b"".join(bytes(p["bytes"]) for p in pieces) == text.encode()
    assert [i for p in pieces for i in p["ids"]] == encoder.encode_ordinary(text)


def test_classes_are_the_encoders():
    classes, kinds = byte_bpe.Classes(), {"a": r"\p{L}", "1": r"\p{N}", "!": r"[^\s\p{L}\p{N}]", "\n": r"\s"}
    for point in [*range(0x500), 0x4E00, 0x3042, 0x1F600, 0x3000, 0x0301, 0x0E01, 0x661]:
        assert regex.match(kinds[classes[chr(point)]], chr(point)), hex(point)


def test_stitched_only_where_classes_change(encoder):
    found = byte_bpe.boundaries("ab  cd\n\nx's y\u0558z", (0, 99))[0]
    assert found.tolist()[:4] == [0, 2, 6, 9]
    text = "ab  cd\n\nx's y\u0558z"
    for cut in found.tolist():
        assert encoder.encode_ordinary(text[:cut]) + encoder.encode_ordinary(text[cut:]) == encoder.encode_ordinary(text)
    assert [len(x) for x in byte_bpe.boundaries("", (0, 9), (0, 0))] == [1, 0]


def test_very_long_blanks(encoder):
    for blanks in (" " * 100_001, "\n" * 100_001, "\t " * 60_000):
        for text in (blanks, "a" + blanks + "b", "it's" + blanks + "\u0301" + blanks, blanks + "'s" + blanks):
            assert byte_bpe.text_ids(encoder, text) == encoder.encode_ordinary(text)
    assert len(byte_bpe.text_ids(encoder, "a" + "\n" * 2_000_000 + "b")) > 1_000
