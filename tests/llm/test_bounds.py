"""Work and memory stay in proportion to the text, whatever it looks like."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seriesmill.llm import suffix_arrays, token_counts


class Counting:
    """A tokenizer that notes how many characters it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.characters = tokenizer, 0

    def encode_batch(self, texts, **options):
        self.characters += sum(map(len, texts))
        return self.tokenizer.encode_batch(texts, **options)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))


@pytest.mark.parametrize("run", [300_000, 50_000, 20_000, 9_000])
def test_long_runs_without_white_space_are_encoded_a_few_times_at_most(tokenizer, run):
    r = random.Random(run)
    text = " ".join("".join(r.choices("abcdefgh日本é.,0", k=run)) for _ in range(300_000 // run))
    counting = Counting(tokenizer)
    assert token_counts.count_in_chunks(text, counting) == len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert counting.characters <= 8 * len(text)


def test_runs_between_plain_words(tokenizer):
    r = random.Random(2)
    parts = []
    for _ in range(60):
        parts += ["plain words in between " * r.randrange(1, 60), "".join(r.choices("xyzé", k=r.randrange(1, 400))), "\n \t"]
    text = "".join(parts)
    for chunk, overlap in ((200, 8), (64, 16), (1000, 100)):
        assert token_counts.count_in_chunks(text, tokenizer, chunk, overlap) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_blocks_of_the_benchmark_hold_as_many_words_in_any_script(spark, monkeypatch):
    monkeypatch.setattr(suffix_arrays, "BLOCK_WORDS", 2_000)
    for letters in ("abc", "абв"):
        r = random.Random(1)
        items = [(f"i{k}", " ".join("".join(r.choices(letters, k=6)) for _ in range(50))) for k in range(200)]
        blocks = suffix_arrays._blocks(spark.createDataFrame(items, "item_id STRING, text STRING"), 13)
        sizes = [len(b.value.words) for b in blocks]
        assert sum(sizes) == 10_000 and len(sizes) == 5 and max(sizes) <= 2 * 2_000
