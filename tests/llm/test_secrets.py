import random
import re
import time

import regex

from quillmart.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def linked(text, reach=secrets.REACH):
    """The weak candidates that brute force over all pairs of parts confirms."""
    text = text or ""
    weak = []
    for kind, pattern in secrets.WEAK.items():
        for m in regex.finditer(pattern, text):  # look-behinds of several lengths
            if kind != "key" or all(re.search(p, m[0]) for p in secrets.KEY_PARTS):
                weak.append((m.start(), m.end(), secrets.KINDS.index(kind)))
    scope = lambda s: sum(m.end() <= s[0] for m in re.finditer(secrets.PARAGRAPH, text))
    secret = {secrets.KINDS.index(k) for k in secrets.SECRET_PARTS}
    return [w for w in weak if any(
        (o[2] in secret) != (w[2] in secret) and scope(o) == scope(w)
        and 0 <= max(w[0] - o[1], o[0] - w[1]) <= reach for o in [*base(text), *weak])]


def texts():
    rng = random.Random(6)
    parts = ["password = 'hunter22!'", "token: abc", "secret=token: abcdefg", "api_key:=x", "APIKEY = \"a1b2c3d4\"", "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 9,
             "0123456789abcdef01234567", "deadbeef" * 5, "user: bob42", "client_id=ab-12", "https://a.b.c/x?y=1", "db.host.net:5432",
             "aB3" * 12, "aB3" * 9, "ünïcode😀", "\n\n", " \n \n ", "x" * 420, "plain words here", "ſecret=abcdefg", "toKen=abcdefg"]
    return ["", None] + ["".join(rng.choice(parts) + rng.choice([" ", "", "\n", " "]) for _ in range(rng.randint(1, 12))) for _ in range(400)]


def test_spans_equal_brute_force(spark, clash):
    docs = [(i, t) for i, t in enumerate(texts())] + [(7, "user: a1b token=abcdef"), (7, "user: a1b token=abcdef"), (None, "user: a1b token=abcdef")]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = secrets.scan(df, "doc_id", "text").collect()
    got = sorted((str(r.id), [(s.start, s.end, s.kind) for s in r.base], [(s.start, s.end, s.kind) for s in r.spans]) for r in rows)
    want = sorted((str(i), base(t), sorted(set(base(t)) | set(linked(t)), key=lambda s: (s[0], s[2]))) for i, t in docs)
    assert got == want
    assert any(len(s) > len(b) for _, b, s in want)
    assert secrets.scan(df.limit(0), "doc_id", "text").count() == 0


def test_redact(spark, clash):
    docs = [(1, "x"), (None, None), (2, "user: bob42 and password = 'hunter22!' 😀 token: abc\n\nuser: lonely"), (3, "token=" + "ab" * 20)]
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    out = secrets.redact(df, "doc_id", "text")
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "x", None: None, 2: "[SECRET] and [SECRET]!' 😀 token: abc\n\nuser: lonely", 3: "[SECRET]"}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "user: bob42 token=abcdef")], "doc_id long, text string")
    for out in (secrets.scan(df, "doc_id", "text"), secrets.redact(df, "doc_id", "text")):
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_weak_runs_are_taken_to_their_end(spark):
    url = "https://files.host.net/x?" + "&".join(f"p{i}=value{i}" for i in range(30)) + "&sig=Zm9vYmFy"
    weak = [url, "user: " + "a1" * 50, "user" + " " * 9 + "=" + " " * 7 + "bob42", "10.0.0.12:5432", "localhost:5432", "db-1:5432",
            "My.Db.node7:5432", ".".join(["part"] * 12) + ".host.net:5432", "a" * 70 + ".net:5432"]
    assert len(url) > 275
    docs = [(i, f"{w} token=abcdef") for i, w in enumerate(weak)]
    plain = ["at 10:30 or 2024-01-01T10:30 or 1.5:30 or 1.2.3.4.5:30"]
    docs += [(100 + i, f"{w} token=abcdef") for i, w in enumerate(plain)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.id: [(s.start, s.end, s.kind) for s in r.spans if s.kind >= len(secrets.BASE)] for r in secrets.scan(df, "doc_id", "text").collect()}
    for i, w in enumerate(weak):
        assert [s[:2] for s in found[i]] == [(0, len(w))], w
    assert not found[100]
    text = {r.doc_id: r.text for r in secrets.redact(df, "doc_id", "text").collect()}
    assert all(text[i] == "[SECRET] [SECRET]" for i in range(len(weak)))


def test_parts_link_across_a_whole_scope(spark):
    lines = "\n".join(f"line {i} of a long block" for i in range(200))
    first, last, key = "user: bob42", "password = hunter22", "aB3" * 12
    texts = [f"{first}\n{lines}\n{last}", f"{last}\n{lines}\nhttps://a.b.net/x", f"{key}\n{lines}\ndb.host.net:5432",
             f"{first}\n{lines}\n\n{last}", "see https://a.b.net/x?token=abcdefg"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = {r.id: sorted(secrets.KINDS[s.kind] for s in r.spans) for r in secrets.scan(df, "doc_id", "text").collect()}
    assert names == {0: ["assign", "user"], 1: ["assign", "endpoint"], 2: ["endpoint", "key"], 3: ["assign"], 4: ["assign"]}
    clean = secrets.redact(df, "doc_id", "text").where("doc_id = 0").first().text
    assert clean == f"[SECRET]\n{lines}\n[SECRET]"


def test_kinds_in_order_where_they_share_a_start(spark):
    docs = [(1, "secret:54321.abc password = hunter22"), (2, "login:5432.x password = hunter22")]
    rows = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()
    names = {r.id: [(s.start, secrets.KINDS[s.kind]) for s in r.spans] for r in rows}
    assert names[1][:2] == [(0, "assign"), (0, "endpoint")] and names[2][:2] == [(0, "user"), (0, "endpoint")]


def test_long_texts_end_in_seconds(spark):
    many = "AKIA" + "Z9" * 8 + " "
    texts = [many * 100_000, "a--" * 350_000, "user: bob42 token=abcdefg\n\n" * 50_000]
    spark.createDataFrame([(0, "warm")], "doc_id long, text string").transform(lambda d: secrets.scan(d, "doc_id", "text")).collect()
    for i, (text, n) in enumerate(zip(texts, (100_000, 0, 100_000))):
        begin = time.time()
        df = spark.createDataFrame([(i, text)], "doc_id long, text string")
        row = secrets.scan(df, "doc_id", "text").first()
        assert len(row.spans) == n and time.time() - begin < 40
    clean = secrets.redact(df, "doc_id", "text").first().text
    assert clean == "[SECRET] [SECRET]\n\n" * 50_000
