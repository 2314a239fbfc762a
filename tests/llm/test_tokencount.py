import random
import tracemalloc

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from subscope.llm import tokencount as tc
from tests.llm import cases

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(vocabulary, unknown):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unknown, False))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend(tc.MARK), normalizers.Replace(" ", tc.MARK)])
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def whole():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


@pytest.mark.parametrize("seed", range(6))
def test_small_vocabularies_with_many_ties(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "c", tc.MARK]
    pieces = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(25)} | ({tc.MARK} if seed % 2 else set())
    step = 1.0 if seed % 3 else 0.1
    vocabulary = [("<unk>", 0.0)] + [(p, -step * rng.randint(1, 4)) for p in sorted(pieces)]
    expected, own = library(vocabulary, 0), tc.Counter(vocabulary, 0)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "c", " ", "é", "\n"]) for _ in range(rng.randint(0, 30)))
        assert own.count(text)[0] == expected(text), (vocabulary, text)


EXPECTED = library(*whole())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "ing", " ", "  ", "\n", "12", "é", "中", "\U0001f600", tc.MARK, "<unk>", "ñas"]), max_size=40))
def test_the_file_as_a_unigram_vocabulary(parts):
    text = "".join(parts)
    assert tc.counter(PATH).count(text)[0] == EXPECTED(text)


def test_units_are_independent_in_the_file():
    assert tc.counter(PATH).apart


def test_whole_tables(spark):
    for docs in (cases.odd(spark), spark.read.parquet(f"{cases.SMALL}/documents.parquet")):
        found = sorted((repr(r["doc_id"]), r["n_tokens"]) for r in tc.counts(docs, PATH).collect())
        assert found == sorted((repr(i), EXPECTED(t)) for i, t in cases.texts_of(docs))
    assert tc.counts(cases.none(spark), PATH).count() == 0


def test_memory_does_not_follow_an_unbroken_stretch():
    own = tc.Counter(*whole())
    text = "thequickbrownfox" * 20_000 + "\u4e2d" * 1000
    assert own.count(text)[0] == EXPECTED(text)
    tracemalloc.start()
    own.search(tc.MARK + text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(text)  # four arrays of all places took 95 bytes a character
