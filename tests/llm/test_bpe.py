import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subscope.llm import bpe
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "th", "ing", " ", "  ", "\n", "1", "##", "'s", "é", "中文", "\U0001f600", "\t", "<|endoftext|>", "\xa0"]), max_size=60), st.sampled_from([2, 5, 11, 2048]))
def test_tree_concatenation_equals_the_library(parts, leaf):
    text = "".join(parts)
    ids = bpe.encode_text(text, PATH, leaf)
    assert ids == library(text)
    assert bpe.decode_ids(ids, PATH) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("unit", ["a", "ab", "0", "-", " ", "thing", "é"])
def test_long_stretches(unit):
    text = unit * 5000
    assert bpe.encode_text(text, PATH, 64) == library(text)


# every class of the pattern, alone and mixed, far above what the encoder takes at once
RUNS = [" ", "\n", "\t", "\xa0", "\u2003", " \n", "\n ", "\r\n", "\x1c", "\x85", "a", "é", "中", "7", "٣", "-", "=+", "\U0001f600", "\u0301", "\u200b", "'s", "a ", "1a"]


@pytest.mark.parametrize("unit", RUNS)
def test_a_million_characters_of_a_class(unit):
    text = "x" + unit * (1_000_000 // len(unit)) + "y"
    ids = bpe.encode_text(text, PATH)
    assert bpe.decode_ids(ids, PATH) == text
    assert ids == library(text)


def test_three_million_blanks_of_all_kinds_over_tasks(spark):
    rng = random.Random(2)
    texts = ["\n" * 3_000_000, "".join(rng.choice(["\n" * 5000, " " * 3000, "\t\xa0" * 4000, "word ", "ab" * 2500]) for _ in range(600))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for k, text in enumerate(texts):
        assert rows[k]["decoded"] == text and np.frombuffer(rows[k]["ids"], "<u4").tolist() == library(text)


@pytest.mark.parametrize("part", [50, 700, bpe.PART])
def test_whole_tables_and_pieces_over_tasks(spark, part):
    docs = cases.odd(spark)
    found = bpe.encode(docs, PATH, leaf=64, part=part)
    rows = bpe.decode(found, PATH).collect()
    assert sorted((repr(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4"))) for r in rows) == sorted((repr(i), tuple(library(t))) for i, t in cases.texts_of(docs))
    assert sorted((repr(r["doc_id"]), r["decoded"]) for r in rows) == sorted((repr(i), t) for i, t in cases.texts_of(docs))
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in rows)
    at_once = bpe.encode(docs, PATH, leaf=64, part=part, decoded=True)
    assert sorted(map(repr, at_once.collect())) == sorted(map(repr, bpe.decode(found, PATH).collect()))


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(cases.none(spark), PATH), PATH).count() == 0


def test_join_of_random_halves():
    rng = random.Random(5)
    enc, _ = bpe.tokenizer(PATH)
    for _ in range(100):
        text = "".join(rng.choice(["a", "b", "er", "th", "in"]) for _ in range(rng.randint(2, 200)))
        at = rng.randint(1, len(text) - 1)
        assert bpe.join(enc.encode_ordinary(text[:at]), enc.encode_ordinary(text[at:]), enc) == enc.encode_ordinary(text)
