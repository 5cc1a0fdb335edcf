"""The code, the probabilities, and the counts of the language model."""

import collections
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import mixlm
from gaugeline.llm.common import text_groups
from gaugeline.llm.queries import QUERIES

TRAINING = ["the cat sat on the mat", "the dog sat on the cat", "a dog and a cat and a mouse"] * 5
#: Each bit is in the table of each context.
CONTEXT_BITS = mixlm.CONTEXTS


def tokens_of(*texts):
    [(_, raw, offsets)] = text_groups(pa.array([*texts], pa.string()), 1 << 30)
    return mixlm.Tokens(raw, offsets)


@pytest.fixture(scope="module")
def model():
    tokens = tokens_of(*TRAINING)
    keys, counts = np.unique(tokens.hashes, return_counts=True)
    often = counts >= mixlm.TIMES
    letters = np.bincount(tokens.text, minlength=256)
    code = mixlm.Code.of(keys[often], counts[often], len(tokens.hashes), letters)
    counter = mixlm.Counter(code)
    counter.add(tokens)
    slots = []
    for low, high in zip(mixlm.OFFSETS, mixlm.OFFSETS[1:]):
        zeros, ones = counter.counts[2 * low : 2 * high].reshape(-1, 2).T.astype(float)
        slots.append(mixlm._packed(zeros, ones))
    weights = mixlm.fitted_weights(code, counter.counts, [t.encode() for t in TRAINING])
    return mixlm.Model(code, slots, weights)


def score(model, *texts):
    tokens = tokens_of(*texts)
    return model.log10(tokens, model.code.numbers(tokens.hashes))


@pytest.mark.parametrize("counts", [[1], [5, 1], [1, 1, 1], [100, 40, 3, 1, 1, 0], [2**60] + [1] * 300])
def test_code_words_are_a_prefix_code(counts):
    words, lengths = mixlm.code_words(np.array(counts))
    assert lengths.max() < 32
    texts = [format(w, "b").zfill(n) if n else "" for w, n in zip(words.tolist(), lengths.tolist())]
    if len(counts) > 1:
        assert sum(2.0**-n for n in lengths.astype(float)) == pytest.approx(1)
        assert not any(a != b and b.startswith(a) for a, b in itertools.permutations(texts[:40], 2))


def test_bits_spell_the_code_words():
    words, lengths = mixlm.code_words(np.array([50, 20, 20, 5, 3, 1, 1, 1, 1, 1]))
    symbols = np.array([0, 9, 3, 3, 1, 7])
    bits = mixlm.Bits(words[symbols], lengths[symbols], 0)
    want = "".join(format(w, "b").zfill(n) for w, n in zip(words[symbols].tolist(), lengths[symbols].tolist()))
    assert "".join(map(str, bits.turns.tolist())) == want
    one = bits.slots(np.zeros(6, np.uint32), 18)
    other = bits.slots(np.arange(6, dtype=np.uint32), 18)
    assert len(one) == len(want) and (one < 1 << 18).all() and (one != other).any()


def test_probabilities_of_all_texts_sum_to_one_at_most(model):
    vocabulary = ["the", "cat", "dog", "a", "and", "on", "sat", "mat", "x"]
    total = 0.0
    for n in range(4):
        texts = [" ".join(p) for p in itertools.product(vocabulary, repeat=n)]
        total += float((10 ** score(model, *texts)).sum())
    assert 0.02 < total <= 1


def test_a_score_does_not_depend_on_neighbours(model):
    texts = ["the cat", "", "zyx wvu " * 900, "the dog sat on the mat " * 700, "cat", "ÄÖ é"]
    together = score(model, *texts)
    assert np.allclose(together, [score(model, t)[0] for t in texts], rtol=1e-6)
    assert np.allclose(score(model, *reversed(texts)), together[::-1], rtol=1e-6)
    assert together[1] < 0


def test_long_texts_in_pieces(model, monkeypatch):
    text = "the cat sat on a new zebra and " * 500
    want = score(model, text)[0]
    monkeypatch.setattr(mixlm, "PIECE", 100)
    assert score(model, text)[0] == pytest.approx(want, rel=2e-3)


def test_training_text_is_likelier_than_noise(model):
    likely, noise = score(model, "the cat sat on the mat", "qqx zzk vvw jjq xkq pzw")
    assert likely > noise / 4


def brute(rows):
    """n_tokens, n_known, train_tokens and base score of each id."""
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    taught = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(t for i in taught for t in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t))
        for i, t in tokens.items()
    }


def test_base_scores_and_held_out_likelihood(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(rows)
    got = QUERIES["op7_lm_scoring"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        n_tokens, n_known, n, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    for held in (False, True):
        part = [r for r in got if r.held_out == held]
        # one training document in seven, so new words are common: near the base, or better
        assert sum(r.score for r in part) > 1.1 * sum(r.base_score for r in part)
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)


def test_odd_rows(spark, docs):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (3, "a B a"), (4, "a b c " * 30_000), (5, "x"), (5, "x"), (None, "a b")]
    got = mixlm.scores(docs(*rows), F.coalesce(F.col("doc_id") != 3, F.lit(True))).collect()
    assert len(got) == 7
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].score == by_id[2].score < 0 and by_id[1].n_tokens == by_id[1].n_known == 1
    assert by_id[3].held_out and not by_id[None].held_out and by_id[3].n_known == 4
    assert len({(r.score, r.base_score) for r in got if r.doc_id == 5}) == 1
    assert by_id[4].bits_per_byte < 1


def test_nothing_to_learn_from(spark, docs):
    from pyspark.sql import functions as F

    got = mixlm.scores(docs((1, "a b"), (2, None)), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens) for r in sorted(got, key=lambda r: r.doc_id)] == [(0, 0), (0, 0)]
    assert all(r.score < 0 and r.base_score == 0 for r in got)
    assert mixlm.scores(docs(), F.lit(True)).count() == 0


def test_weights_are_fitted_to_all_training_texts(spark, docs, monkeypatch):
    """Every bit of every training text is counted, in tasks as in one piece, in pieces as in groups."""
    texts = [*TRAINING, "", "zyx wvu " * 3000, *(f"text {i} of many the cat {i % 7}" for i in range(900))]
    tokens = tokens_of(*texts)
    keys, counts = np.unique(tokens.hashes, return_counts=True)
    often = counts >= mixlm.TIMES
    letters = np.bincount(tokens.text, minlength=256)
    code = mixlm.Code.of(keys[often], counts[often], len(tokens.hashes), letters)
    counter = mixlm.Counter(code)
    counter.add(tokens)
    fit = mixlm.Fit(code, counter.counts)
    fit.add(tokens)
    cells, n = fit.counted()
    assert CONTEXT_BITS * n.sum() == counter.counts.sum() and not fit.seen.any() and not fit.own.any()
    monkeypatch.setattr(mixlm, "PIECE", 100)
    for text in texts:
        fit.add(tokens_of(text))
    assert [x.tolist() for x in fit.counted()] == [cells.tolist(), n.tolist()]
    frame = docs(*enumerate(texts)).repartition(5)
    assert np.array_equal(mixlm.fit_to(frame, code, counter.counts), mixlm.regressed_weights(cells, n))


def test_counts_beyond_32_bits_keep_their_odds():
    counts = np.array([5, 7, 1 << 33, 1 << 32, (1 << 32) - 1, 3, 1 << 40, 0], np.uint64)
    got = mixlm.halved(counts).astype(np.float64)
    assert got[:2].tolist() == [5, 7] and got[4:6].tolist() == [(1 << 32) - 1, 3]
    assert got[2] / got[3] == 2 and got[2] < 1 << 32 and got[6] > 1 << 30 and got[7] == 0


@pytest.mark.parametrize("times", [1, 40, 3000])
def test_few_slots_are_counted_for_each_text(times, monkeypatch):
    """Ways through groups of bits give what slots give, and most of them do without the slots."""
    rng = np.random.default_rng(times)
    words = np.array([f"w{i}" for i in range(400)])
    share = 1 / np.arange(1, 401)
    texts = [" ".join(rng.choice(words, 60, p=share / share.sum())) + f" new{i}" for i in range(300)]
    tokens = tokens_of(*texts)
    keys, counts = np.unique(tokens.hashes, return_counts=True)
    often = counts >= mixlm.TIMES
    code = mixlm.Code.of(keys[often], counts[often], len(tokens.hashes), np.bincount(tokens.text, minlength=256))
    counter = mixlm.Counter(code)
    counter.add(tokens)
    fit = mixlm.Fit(code, counter.counts * np.uint32(times))
    met = []
    rest = fit._rest
    monkeypatch.setattr(fit, "_rest", lambda k, slots, own: (met.append(len(slots)), rest(k, slots, own))[1])
    fit.add(tokens)
    cells, n = fit.counted()
    assert sum(met) < {1: 0.9, 40: 0.7, 3000: 0.3}[times] * counter.counts.sum()
    assert not (fit.own.any() or fit.visits.any() or fit.marked.any())
    met.clear()
    monkeypatch.setattr(mixlm, "PIECE", 7)
    for text in texts:
        fit.add(tokens_of(text))
    assert sum(met) == counter.counts.sum()
    assert [x.tolist() for x in fit.counted()] == [cells.tolist(), n.tolist()]


def test_arrays_in_tasks_have_numpys_own_types(model):
    """Loops of numpy that ask for a type itself are many times slower with a pickled copy of it."""
    import pickle

    from pyspark import cloudpickle

    sent = pickle.loads(cloudpickle.dumps(model.code))
    assert sent.keys.dtype is not np.dtype(np.uint64)
    got = mixlm.native(sent)
    assert got.keys.dtype is np.dtype(np.uint64) and np.array_equal(got.keys, model.code.keys)
    assert got.common.dtype is got.keys.dtype and got.most == model.code.most

    names = {"one": pickle.loads(cloudpickle.dumps(mixlm._ONE)), "many": [pickle.loads(cloudpickle.dumps(mixlm._TURNS))]}
    mixlm.make_native(names)
    assert names["one"].dtype is np.dtype(np.uint64) and names["many"][0].dtype is np.dtype(np.uint8)


def test_counts_are_those_of_single_bits(model, spark, docs):
    """Ways through groups, tokens without context and narrow sums of tasks add up to the bits of each slot."""
    texts = [*TRAINING, "the cat " * 70_000, "zyx wvu utsr " * 400, "", "a"]
    want = np.zeros(2 * int(mixlm.OFFSETS[-1]), np.uint32)
    counter = mixlm.Counter(model.code)
    for text in texts:
        tokens = tokens_of(text)
        counter.add(tokens)
        symbols = model.code.numbers(tokens.hashes)
        parts, _ = mixlm.predicted(model.code, tokens, symbols, slice(None), model.code.first())
        for bits, contexts, _ in parts:
            for k in range(mixlm.CONTEXTS):
                at = 2 * (bits.slots(contexts[k], mixlm.TABLES[k]).astype(np.int64) + mixlm.OFFSETS[k]) + bits.turns
                np.add.at(want, at, np.uint32(1))
    assert want.max() > 1 << 16 and np.array_equal(counter.counts, want)
    assert np.array_equal(counter.counts, want)
    got = mixlm.train(docs(*enumerate(texts)).repartition(3), model.code)
    for k, (low, high) in enumerate(zip(mixlm.OFFSETS, mixlm.OFFSETS[1:])):
        zeros, ones = want[2 * low : 2 * high].reshape(-1, 2).T.astype(float)
        assert np.array_equal(got.slots[k], mixlm._packed(zeros, ones))


def test_tables_are_sent_small():
    counts = np.zeros(1 << 20, np.uint32)
    counts[::100] = 7
    sent = mixlm.Sent.of(counts)
    assert len(sent.raw) < counts.nbytes / 20 and np.array_equal(sent.array(), counts)
    assert sent.array().dtype is np.dtype(np.uint32)
