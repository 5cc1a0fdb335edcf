"""Byte-level BPE against the tiktoken library, edits against encoding anew, and odd rows."""

import random
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.llm import prefix_bpe
from gaugeline.llm.queries import op11_byte_bpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    ranks = prefix_bpe.read_ranks(public_tokenizers.path(request.param))
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return prefix_bpe.Encoder(ranks, PATTERN), library


ALPHABETS = ["ab", "abcde thein", " \n\t　a", "'srevldtmx ", "éèêüß 中文字🎉 \x1c\x85", "0123456789.,-= "]


def texts(rng, n):
    for _ in range(n):
        letters = rng.choice(ALPHABETS)
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))


def test_same_ids_as_the_library(both):
    encoder, library = both
    for text in texts(random.Random(1), 1500):
        want = library.encode_ordinary(text)
        assert list(array("i", encoder.encode(text))) == want
        assert list(encoder.back(encoder.table(text))) == want


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60))
def test_any_text(text):
    encoder, library = _first()
    assert list(array("i", encoder.encode(text))) == library.encode_ordinary(text)


_KEPT: list = []


def _first():
    if not _KEPT:
        ranks = prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
        library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _KEPT.extend([prefix_bpe.Encoder(ranks, PATTERN), library])
    return _KEPT


def test_every_prefix_has_its_own_last_token(both):
    encoder, library = both
    for word in ("thereinafter", "aaaaaaaaaaaaa", "éèêüßüber", "================"):
        piece = word.encode()
        table = array("i")
        encoder.fill(piece, table)
        for end in range(1, len(piece) + 1):
            want = library._core_bpe.encode_single_piece(piece[:end])
            assert table[end - 1] == want[-1]


def test_small_vocabularies_with_odd_ranks():
    """Tokens whose parts come later, and tokens that no merges lead to."""
    rng = random.Random(5)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        for _ in range(rng.randint(1, 25)):
            token = bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 4)))
            ranks.setdefault(token, len(ranks))
        encoder = prefix_bpe.Encoder(ranks, r"\S+|\s+")
        library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        if any(encoder._halves(r) is None for r in ranks.values()):
            # then prefixes need not have one last token, but ids still have to be right or an error
            continue
        # later tokens as parts of earlier ones break the order that all trained vocabularies have
        if any(max(encoder._halves(r)) > r for t, r in ranks.items() if len(t) > 1):
            continue
        for _ in range(40):
            text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 20)))
            assert list(array("i", encoder.encode(text))) == library.encode_ordinary(text)


def test_edits_look_near_the_edit_only(both):
    encoder, _ = both
    rng = random.Random(2)
    for text in texts(rng, 1500):
        table = encoder.table(text)
        start = rng.randint(0, len(text))
        stop = rng.randint(start, len(text))
        put = "".join(rng.choice("ab e'sé \n") for _ in range(rng.randint(0, 5)))
        new, revised, _ = encoder.revise(text, table, start, stop, put)
        assert new == text[:start] + put + text[stop:]
        assert revised == encoder.table(new)
    words = "the quick brown fox jumps over the lazy dog. " * 500
    _, _, looked = encoder.revise(words, encoder.table(words), 9000, 9003, "cat")
    assert looked < 60
    one = "".join(rng.choice("thein") for _ in range(20_000))
    _, revised, looked = encoder.revise(one, encoder.table(one), 9000, 9001, "q")
    assert looked < 500 and revised == encoder.table(one[:9000] + "q" + one[9001:])


def test_appends_look_at_the_end_only(both):
    encoder, _ = both
    text, table, looked = "", array("i"), 0
    for part in ["Hello", " wor", "ld", "'", "ll", "  ", "\n", " x", "1", "23 "] * 50:
        text, table, n = encoder.revise(text, table, len(text), len(text), part)
        looked += n
    assert table == encoder.table(text)
    assert looked < 6 * len(text)


@pytest.fixture(scope="module")
def ranks():
    return prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_query_agrees_with_the_library(spark, sf_dir, documents):
    import hashlib

    _, library = _first()
    got = {r.doc_id: r for r in op11_byte_bpe(spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows) > 0
    for row in rows:
        ids = library.encode_ordinary(row.text or "")
        found = got[row.doc_id]
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_odd_rows(spark, docs, clashing, ranks, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "BATCH_BYTES", 100)
    long = "word " * 50_000 + "x" * 100_000
    frame = clashing(docs((1, None), (1, None), (2, ""), (3, long), (4, "a b"), (4, "a b"), (None, "é")), "ids", "decoded")
    encoded = prefix_bpe.encode(frame, ranks, PATTERN, tables=True)
    assert encoded.columns[-4:] == ["ids", "decoded", "ids_", "last_tokens"]
    back = prefix_bpe.decode(encoded, ranks, "ids_")
    assert back.columns[-2:] == ["decoded_", "packed"]
    rows = back.collect()
    assert len(rows) == 7
    for row in rows:
        assert bytes(row.decoded_).decode() == (row.text or "") and row.ids == "kept ids"
        assert bytes(row.packed) == np.array(row.ids_, "<u4").tobytes()
        assert len(row.last_tokens) == len((row.text or "").encode())
    empty = prefix_bpe.encode(docs(), ranks, PATTERN)
    assert prefix_bpe.decode(empty, ranks).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert prefix_bpe.decode(nothing, ranks).first().decoded == b""
    with pytest.raises(Exception, match="not in the vocabulary"):
        prefix_bpe.decode(spark.createDataFrame([([70000],)], "ids array<int>"), ranks).collect()
    with pytest.raises(ValueError, match="single bytes"):
        prefix_bpe.Encoder({b"a": 0}, PATTERN)


def test_revised_rows(spark, docs, ranks):
    kept = prefix_bpe.encode(docs((1, "The cat sat."), (2, "one two"), (3, None)), ranks, PATTERN, tables=True)
    edits = kept.select(
        "*",
        F.expr("CASE doc_id WHEN 1 THEN 4 END").alias("start"),
        F.expr("CASE doc_id WHEN 1 THEN 7 END").alias("stop"),
        F.expr("CASE doc_id WHEN 1 THEN 'dog' WHEN 2 THEN ' three' END").alias("put"),
    )
    rows = {r.doc_id: r for r in prefix_bpe.revise(edits, ranks, PATTERN).collect()}
    assert [rows[i].new_text for i in (1, 2, 3)] == ["The dog sat.", "one two three", ""]
    encoder, _ = _first()
    for row in rows.values():
        assert row.new_ids == list(array("i", encoder.encode(row.new_text)))
        assert row.new_last_tokens == list(encoder.table(row.new_text))
