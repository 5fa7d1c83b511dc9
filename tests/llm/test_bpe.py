import random

import pytest
from tokenizers import Tokenizer

import public_tokenizers
from quillmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = [
    "", " ", "\n ", " \n", "a<|endoftext|>b <|endoftext|>", " x\x1c\x1dy  z\n\n", "日本語 テスト 😀😀  x", "a" * 3000,
    "ab" * 500 + "!!!" * 300, "é don't I'LL 123४५", "a \xa0b\xa0 c\x85d \n e'sfoo ''s 's 'll've'", "x '", "'re", "a\xa0'sb \xa0\xa0",
    "don't'd'x 12'm½ ²a", "'s's'",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(library):
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice(" \n'sstremvld12½é\xa0!\"×x\t\x1c") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    codec = bpe.codec(PATH)
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.decode([ids])[0] == text


def test_broken_utf8_decodes_as_the_library(library):
    codec = bpe.codec(PATH)
    ids = codec.encode(["日本"])[0]
    assert codec.decode([ids[:1], ids[1:]]) == [library.decode(ids[:1].tolist()), library.decode(ids[1:].tolist())]


def test_rows(spark, clash):
    df = clash(spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None), (2, "")], "doc_id long, text string"))
    rows = bpe.encode(df, "doc_id", "text", decoded=True).collect()
    assert sorted((r.id is None, r.id, r.decoded, len(r.ids)) for r in rows if r.id) == [
        (False, 1, "one two", 2), (False, 1, "one two", 2), (False, 2, "", 0)]
    assert [(r.decoded, r.ids) for r in rows if r.id is None] == [("", [])]
    back = bpe.decode(bpe.encode(df, "doc_id", "text"), "id", "ids")
    assert sorted(r.text for r in back.collect()) == ["", "", "one two", "one two"]
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0
