import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from quillmart.llm import pii
from quillmart.llm.common import table

SF = "/root/testdata/sf0.001"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
PATTERNS = [EMAIL, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def holds(kind, v):
    d = re.sub("[^0-9]", "", v)
    return [True, kind != 1 or all(int(p) <= 255 for p in v.split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15][kind]


def base(text):
    """(start, end, kind, value, before, after), by the contract's own patterns."""
    out = []
    for kind, p in enumerate(PATTERNS):
        found = list(re.finditer(p, text or ""))
        for i, m in enumerate(found):
            if holds(kind, m[0]):
                left = found[i - 1].end() if i else 0
                right = found[i + 1].start() if i + 1 < len(found) else len(text)
                out.append((m.start(), m.end(), kind, m[0], text[max(left, m.start() - 80):m.start()], text[m.end():min(right, m.end() + 80)]))
    return sorted(out, key=lambda s: (s[0], s[2]))


def words(piece, at):
    pos = 0
    while m := re.compile(rf"{EMAIL}|(?<![^\W_])[^\W\d_][^\W_]{{2,}}").search(piece, pos):
        if "@" not in m[0]:
            yield m[0].lower(), at + m.start(), at + m.end()
        pos = m.end()


def contexts(text):
    for start, end, kind, value, before, after in base(text):
        name = (kind, value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value))
        if len(before) == 80:
            before = re.sub(r"\A[^ \t\n\x0b\f\r]+", "", before)
        if len(after) == 80:
            after = re.sub(r"[^ \t\n\x0b\f\r]+\Z", "", after)
        yield name, [*words(before, start - len(before)), *words(after, end)]


def plain(texts):
    """Spans of every text, by counting whole documents in dictionaries."""
    n, event, entity, both, where = len(texts), Counter(), Counter(), Counter(), defaultdict(set)
    for t in texts:
        own = {w for w in re.split(r"[\W_]+", (t or "").lower()) if len(w) >= 3}
        event.update(own | {w[:3] + "*" for w in own})
        found = list(contexts(t or ""))
        entity.update({e for e, _ in found})
        pairs = {(e, x) for e, ws in found for w, _, _ in ws for x in (w, w[:3] + "*")}
        both.update(pairs)
        for p in pairs:
            where[p].add(t)

    def exceeds(e, x):
        information = math.log2(n / entity[e])
        return len(where[e, x]) >= 3 and information > 0 and math.log2(both[e, x] * n / (entity[e] * event[x])) >= 0.9 * information

    out = []
    for t in texts:
        more = {}
        for e, ws in contexts(t or ""):
            for w, a, b in ws:
                if exceeds(e, w):
                    more[a, b] = max(more.get((a, b), 0), 5 if exceeds(e, w[:3] + "*") else 4)
        strong = [(s, k, e) for s, e, k, *_ in base(t or "")]
        out.append((strong, sorted(strong + [(a, k, b) for (a, b), k in more.items()])))
    return out


def text_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(60)] + ["Éé1x", "日本語", "x_y", "o'neil"]
    values = ["ann@mail.example.com", "ANN@mail.example.com", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-0000", "+1 555 0100 00 ()", "300.1.1.1",
              "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "a@@b.c", "x@y", "+12345", "00000000000000", "1.02.003.0004", "0000255.1.1.1"]
    out = [None, ""]
    for i in range(400):
        parts = rng.choices(vocabulary, k=rng.randint(0, 30))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            v = rng.choice(values)
            at = rng.randint(0, len(parts))
            near = {"ann@mail.example.com": ["Zorblax", "zorble"], "10.0.0.1": ["gateway"]}.get(v, [])
            parts[at:at] = [rng.choice(["", "", "<", "x"]) + v + rng.choice(["", ",", ">", "😀"]), *[w for w in near if rng.random() < 0.9]]
        out.append(rng.choice([" ", " ", "\n"]).join(parts))
    return out


def test_spans_equal_brute_force(spark, clash):
    texts = corpus()
    texts += texts[5:9]
    docs = list(enumerate(texts)) + [(7, texts[9]), (7, texts[9]), (None, texts[9])]
    want = plain([t for _, t in docs])
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = pii.scan(df.repartition(5), "doc_id", "text").collect()
    got = sorted((str(r.id), [(s.start, s.kind, s.end) for s in r.base], [(s.start, s.kind, s.end) for s in r.spans]) for r in rows)
    assert got == sorted((str(i), b, s) for (i, _), (b, s) in zip(docs, want))
    kinds = {k for _, s in want for _, k, _ in s}
    assert kinds == {0, 1, 2, 3, 4, 5} or kinds == {0, 1, 2, 3, 5}
    assert pii.scan(df.limit(0), "doc_id", "text").count() == 0


def test_whole_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(docs, plain([r.text for r in docs]))}
    rows = pii.op11_information_sanitisation(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        strong, spans = want[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in strong) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(text_of(strong).encode()).hexdigest() and r.spans == text_of(spans)


def test_terms_are_generalised_or_removed(spark, clash):
    # gateway only stands by the address; gat... also elsewhere.  qqzz is the only word of its kind.
    near = [f"gateway 10.1.2.3 qqzz number {w}" for w in ("one", "two", "three", "four")]
    other = [f"gatehouse and number text {i}" for i in range(40)]
    docs = list(enumerate([*near, *other, "mail a.b@c.de now", None]))
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    out = pii.sanitise(df, "doc_id", "text")
    assert out.columns == df.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[0] == "gat* [IP]  number one" and text[4] == other[0] and text[44] == "mail [EMAIL] now" and text[45] is None


@pytest.mark.parametrize("near", ["wirhost10.1.2.3 one", "one 10.1.2.3wirhost", "one a.b@c.d\u00e9wirhost", "\u0130wirhost 10.1.2.3"])
def test_terms_written_against_a_value_count(spark, near):
    # Before, no document held these terms by count, though contexts showed them.
    docs = list(enumerate([*(f"{near} number {w}" for w in ("two", "three", "four")), *(f"number text {i}" for i in range(40))]))
    rows = {r.id: r for r in pii.scan(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()}
    for i, t in docs[:3]:
        assert any("wirhost" in t[s.start:s.end] for s in rows[i].spans if s.kind in (pii.GENERALISE, pii.REMOVE)), (t, rows[i].spans)
    assert not any(rows[i].spans for i, _ in docs[3:])


def test_terms_by_a_value_and_elsewhere_are_counted_once_a_document(spark):
    docs = [(1, "wirhost10.1.2.3 wirhost"), (2, "wirhost10.1.2.3"), (3, "a wirhost b"), (4, "none")]
    rows = pii._keyed(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    counts = {r.event: r.n_event for r in pii.document_counts(rows, pii._found(rows)).collect()}
    assert counts["wirhost"] == 3 and counts["wir*"] == 3 and counts["wirhost10"] == 2 and counts["none"] == 1


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de now")], "doc_id long, text string")
    for out in (pii.scan(df, "doc_id", "text"), pii.sanitise(df, "doc_id", "text")):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("text", ["a" * 1_000_000, "a@" * 500_000, "1.2.3." * 160_000, "1-" * 500_000, "+1(" * 330_000, "a.a" * 330_000 + "@b", "w@x.yz " * 50_000,
                                  "+1" + " (" * 400_000])
def test_long_texts_take_linear_time(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.time()
    row = pii.scan(df, "doc_id", "text").first()
    assert time.time() - begin < 60
    strong = [(m.start(), 0, m.end()) for m in re.finditer(r"w@x\.yz", text)] if text.startswith("w@") else None
    if strong is not None:
        assert [(s.start, s.kind, s.end) for s in row.base] == strong
