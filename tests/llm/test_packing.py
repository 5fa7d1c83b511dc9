import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import public_tokenizers
from quillmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_library():
    library, codec, rng = Tokenizer.from_file(PATH), packing.word_codec(PATH), random.Random(2)
    texts = ["", "a<|endoftext|>b", " x\x1c\x1dy  z\n\n!\x1c!", "日本語 テスト 😀😀", "a" * 3000, "é don't I'LL 123४५ İstanbul", "½²a\xa0b\x85c"]
    texts += ["".join(rng.choice(" \n'sstremvSTRELld12½é\xa0!\"×x\t\x1cÀ\x85") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2)
    assert bins.place(4) == (0, 0)   # 6 free
    assert bins.place(7) == (1, 0)   # 3 free
    assert bins.place(3) == (1, 7)   # least free space that fits; full, so it closes
    assert bins.place(9) == (2, 0)   # 1 free
    assert bins.place(8) == (3, 0)   # a third bin: the fullest (1 free) closes
    assert bins.place(1) == (3, 8)
    assert bins.place(6) == (0, 4)


def test_packed_sequences(spark, clash):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["lorem", "ipsum", "dolor"]) for _ in range(rng.choice([0, 3, 50, 400])))) for i in range(60)]
    docs += [(60, None), (60, None), (None, "x"), (61, "word " * 5000)]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = packing.pack(packing.pieces(df, "doc_id", "text", capacity=512), capacity=512).toPandas()
    library = Tokenizer.from_file(PATH)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs}
    for r in rows[rows.id.notna()].itertuples():
        own = ids[int(r.id)][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.start == r.piece * 512
    assert rows.length.sum() == sum(len(ids[i]) for i, _ in docs)
    used = rows.sort_values(["sequence_id", "offset"])
    assert (used.groupby("sequence_id").length.cumsum() - used.length == used.offset).all()
    assert used.groupby("sequence_id").length.sum().max() <= 512
    bins = []  # best fit, longest first, all bins open
    for n in sorted(rows.length, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= n]
        if fits:
            bins[min(fits, key=lambda b: bins[b])] -= n
        else:
            bins.append(512 - n)
    assert used.sequence_id.nunique() == len(bins)
    assert packing.pack(packing.pieces(df.limit(0), "doc_id", "text")).count() == 0
