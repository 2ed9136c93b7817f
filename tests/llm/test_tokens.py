import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import packing, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = st.text(alphabet=" \n\t\r▁.,'<|>abcdeéÉßİΣσ日本😀́\x1c\xa0" + "startofext", max_size=60)


@pytest.fixture(scope="module")
def pieces():
    return token_counts.load_model(PIECES)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_parts_add_up(text):
    model = token_counts.load_model(PIECES) if not hasattr(test_parts_add_up, "m") else test_parts_add_up.m
    test_parts_add_up.m = model
    assert sum(token_counts.part_count(p, model) for p in token_counts.pre_tokens(text)) == len(model.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_chunk_ids_are_the_tokenizers(texts):
    own = test_chunk_ids_are_the_tokenizers
    if not hasattr(own, "e"):
        own.e = packing.Encoder(WORDS)
    for text, ids in zip(texts, own.e.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.e.own.encode(text, add_special_tokens=False).ids


def test_special_strings(tokenizer):
    text = "ab<|endoftext|>, <|startoftext|>. x<|endoftext|"
    ids = packing.Encoder(WORDS).encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_the_vocabulary_allows_the_cuts(pieces):
    assert token_counts.split_is_exact(pieces)


def test_token_counts(spark, tmp_path, rows_of, pieces):
    rows = awkward() + [(100 + i, words(i % 5, 40), "en", "a", 1) for i in range(40)]
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    expected = [
        (i, len((t or "").encode()), n := len(pieces.encode(t or "")), n > 4096) for i, t, *_ in rows
    ]
    assert rows_of(token_counts.token_counts(df, PIECES)) == sorted(expected, key=repr)
    assert token_counts.token_counts(stored_docs(spark, tmp_path / "e", []), PIECES).count() == 0


def first_fit_by_hand(lengths, capacity):
    bins, out = [], []
    for n in lengths:
        i = next((i for i, used in enumerate(bins) if used + n <= capacity), len(bins))
        if i == len(bins):
            bins.append(0)
        out.append((i, bins[i]))
        bins[i] += n
    return out


@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_tournament_tree_is_first_fit(lengths):
    lengths.sort(reverse=True)
    bins, offsets = packing.first_fit(np.array(lengths), 50)
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == first_fit_by_hand(lengths, 50)


def test_packing_is_an_exact_round_trip(spark, tmp_path, tokenizer):
    rows = awkward() + [(100 + i, words(i, 30 + 7 * i), "en", "a", 1) for i in range(60)]
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    found = packing.pack(df, WORDS, sequence=256, group_size=32).toPandas()
    ids = {}
    for i, text, *_ in rows:
        ids.setdefault(i, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    assert found["length"].sum() == sum(len(x) for own in ids.values() for x in own)
    for i, *_ in rows:
        own = found[found["doc_id"].isna()] if i is None else found[found["doc_id"] == i]
        made = sorted(zip(own["start"], own["length"], own["ids_crc32"], own["doc_tokens"], strict=True))
        expected = sorted(
            (s, len(x[s : s + 256]), zlib.crc32(np.array(x[s : s + 256], "<u4").tobytes()), len(x))
            for x in ids[i]
            for s in range(0, len(x), 256)
        )
        assert made == expected
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == np.cumsum([0, *sequence["length"]])[:-1].tolist()
        assert sequence["length"].sum() <= 256
    assert packing.pack(stored_docs(spark, tmp_path / "e", []), WORDS).count() == 0


def test_a_small_look_up_gives_the_same_ids(tokenizer):
    own = packing.Encoder(WORDS, limit=40, longest=6, group=5)
    texts = ["Don't \"Say\" (that), <|ENDOFTEXT|> H̱i É...", *(words(i, 60) for i in range(12)), "A.b C,'S ''re x' ≠ #Tag's"]
    for _ in range(2):
        for text in texts:
            assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_words_skip_the_tokenizers_rules():
    """Letters-only ASCII words get their ids from the merges alone, capitals among them, and the same ids."""
    import public_tokenizers

    from mediabatch.llm.packing import Encoder

    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    words = ["Zebra", "qwrtpx", "a", "I", "HTTPServer", "unglaublich"]
    plain = encoder.plain.encode(" ".join(words).lower(), add_special_tokens=False).ids
    assert plain == encoder.own.encode(" ".join(words), add_special_tokens=False).ids
    texts = [" ".join(words), "<|endoftext|> Zebra Zürich's été, don't qwrtpx", "<|x Zebra\tHTTPServer\nI"]
    ids = [encoder.own.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == ids
