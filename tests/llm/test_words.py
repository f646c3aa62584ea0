import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import substring_dedup
from tidemark.llm.words import sliced_words


def hashes(text, seed, length=None):
    ((_, _, found),) = sliced_words(pa.array([text]))
    return found.hashes(seed, length).tolist()


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("seed", [0, 1])
def test_words_that_sums_of_powers_cannot_tell_apart(seed):
    one, two = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    assert len(set(hashes(f"{one} {two} {one}x {two}x", seed))) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=150), min_size=1, max_size=20), st.integers(0, 1))
def test_equal_words_and_only_they_have_equal_hashes(words, seed):
    found = hashes(" ".join(words), seed)
    assert len(set(zip(words, found))) == len(set(words)) == len(set(found))
    assert found[0] == hashes(f"other {words[0]}", seed)[1]
    for word, prefix in zip(words, hashes(" ".join(words), seed, 3)):
        whole = word.encode()[:3]
        if len(whole.decode(errors="ignore").encode()) == len(whole):
            assert prefix == hashes(whole.decode(), seed)[0]


def test_a_passage_with_such_a_word_is_no_repeat_of_another(spark):
    others = " ".join(f"w{i}" for i in range(30))
    texts = [f"{others} {thue_morse(1024, letters)} {others}" for letters in ("ab", "ba")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.dedup(docs).orderBy("doc_id").collect()] == [0, 0]
