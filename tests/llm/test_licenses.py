import random
import re

import pytest

from quillmart.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places_equal_brute_force():
    rng, scanner = random.Random(2), licenses.Scanner()
    vocab = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "MIT", "License", "é", "x", "CC", "BY"]
    for _ in range(4000):
        text = "".join(rng.choice(vocab) + rng.choice([" ", "-", "\n", "", "\x7f", "{", "\xa0"]) for _ in range(rng.randint(0, 25)))
        assert scanner.scan(text)[:5] == base(text), repr(text)


@pytest.mark.parametrize("text,labels,limit", [
    ("mit", ["mit"], .1), ("apache-2.0 or gpl-3.0", ["apache", "gpl"], .2), ("apache-2.0 and gpl-3.0", ["apache", "gpl"], .8),
    ("mit or apache-2.0 and gpl-2.0+", ["mit", "apache", "gpl"], .1), ("(mit or apache-2.0) and gpl-2.0", ["mit", "apache", "gpl"], .8),
    ("gpl-2.0 with classpath-exception-2.0 and mit", ["gpl", "mit"], .4), ("(mit", ["mit"], None), ("mit or", ["mit"], None),
    ("or mit", [], None), (")", [], None), ("", [], None), ("cc-by-4.0 and cc0-1.0", ["cc-by", "cc0"], .2), ("own-1.0", ["own-1.0"], .5),
])
def test_expressions(text, labels, limit):
    assert licenses.evaluate(text) == (labels, limit)


def test_rows(spark, clash):
    docs = [(1, "// SPDX-License-Identifier: Apache-2.0 OR ISC\ncc by"), (1, "cc by"), (1, "cc by"), (None, None), (2, ""), (3, "x " * 100000 + "MIT License")]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = {(r.id, r.n_words): r for r in licenses.scan(df, "doc_id", "text").collect()}
    assert rows[1, 10].labels == "apache,cc-by,isc" and rows[1, 10].base_labels == "cc-by" and rows[1, 10].first_word == 8
    assert rows[3, 100002].first_word == 100000 and rows[2, 0].score == 0.0 and rows[None, 0].labels == ""
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert licenses.scan(df.limit(0), "doc_id", "text").count() == 0


def test_one_line_with_many_tags():
    import time
    text = "SPDX-License-Identifier: MIT then words " * 23_000
    begin = time.time()
    words, *_, labels, _ = licenses.Scanner().scan(text)
    assert labels == "mit" and time.time() - begin < 20
    assert licenses.evaluate("x (MIT or GPL-2.0) end", 2)[0] == licenses.evaluate("(MIT or GPL-2.0)")[0]
