import functools
import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from quillmart.llm import structure
from quillmart.llm.common import table

SF = "/root/testdata/sf0.001"


def damage(rows):
    """Rows (conv, turn, role, text) after damage."""
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        m = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if m:
            text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
            yield from [(conv, turn, "user" if m == 4 else role, text)] * (2 if m == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        kept = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("b" if not kept else "d" if (role, text) in seen else "t" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired turns): recursion from the end over every choice, no agenda and no blocks."""
    found, n = faults(rows), len(rows)

    @functools.lru_cache(None)
    def best(i, last, inserts):
        offers = []
        if i == n and last in ("", "a"):
            offers.append((0, "", ()))

        def add(cost, letter, rest, turn):
            if rest:
                offers.append((cost + rest[0], letter + rest[1], turn + rest[2]))

        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for r in follow:
            if r != "s" and inserts < 2:
                add(3, "I", best(i, r, inserts + 1), ((("user" if r == "u" else "assistant"), ""),))
        if i < n:
            _, _, role, text = rows[i]
            add(4, "D", best(i + 1, last, 0), ())
            if found[i] not in ("b", "d"):
                extra = 3 if found[i] == "t" else 0
                for r in follow:
                    if role[:1] == r:
                        add(extra, "K", best(i + 1, r, 0), ((role, text),))
                    if r != "s":
                        add(3 + extra, "R", best(i + 1, r, 0), ((("user" if r == "u" else "assistant"), text),))
        return min(offers) if offers else None

    for i, last in product(range(n, -1, -1), ("", "s", "u", "a")):  # from the end, so that no call goes deep
        best(i, last, 0)
    return best(0, "", 0)


def plain(table_rows):
    """The query's rows by conversation, for tables without ties between different rows of a turn."""
    out = {}
    for conv in {r[0] for r in table_rows}:
        own = sorted(damage(r for r in table_rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
            continue
        cost, audit, turns = cheapest(own)
        found, ini = faults(own), [r[2][:1] for r in own]
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        text = "\n".join(f"{r}:{t}" for r, t in turns)
        out[conv] = (gaps, found.count("b"), found.count("d"), found.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(spark, path):
    rows = structure.op12_structure_repair(spark, path).collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, SF) == plain(rows)


def test_agenda_equals_recursion():
    texts = {"": "done.", "t": "cut", "b": " "}
    cases = [c for n in range(5) for c in product("sua", repeat=n)]
    rng = random.Random(3)
    for case in cases + [rng.choices("sua ", k=rng.randint(5, 9)) for _ in range(300)]:
        rows = [(0, i, {"s": "system", "u": "user", "a": "assistant"}.get(r, r), f"{texts[rng.choice(['', '', '', 't', 'b'])]}") for i, r in enumerate(case)]
        rows = [(c, i, r, t.replace("done", f"done {rng.randint(0, 3)}")) for c, i, r, t in rows]
        code = {"": structure.NONE, "b": structure.BLANK, "d": structure.DUPLICATE, "t": structure.CUT}
        ini, found = [r[2][:1] for r in rows], [code[f] for f in faults(rows)]
        ends = structure.edits(ini, found, structure.START)
        got = min((c + 3 * len(structure.CLOSING[q]), a + structure.CLOSING[q]) for q, (c, a) in ends.items())
        want = cheapest(rows)
        assert got == want[:2], case
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in want[2]))


@pytest.mark.parametrize("block", [1, 3, 256])
def test_long_and_odd_conversations(spark, tmp_path, clash, monkeypatch, block):
    monkeypatch.setattr(structure, "BLOCK", block)
    rng = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "", "tool"]
    rows = [(1, i, rng.choice(roles), f"turn {rng.randint(0, 40)}{rng.choice('.!? ,')}") for i in range(400)]
    rows += [(2, i, ["user", "assistant"][i % 2], f"{i} 😀.") for i in range(9)] + [(2, 20, None, "no role."), (2, 21, "user", None)]
    rows += [(None, 5, "user", "no id."), (None, 6, "assistant", "yes."), (3, None, "user", "hello."), (4, 0, "system", "only."), (5, 3, "user", "same."), (5, 3, "user", "same.")]
    rows += [(6, 2, "assistant", "x" * 300_000 + ".")]
    dropped = next(i for i in range(100, 999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    df.repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    got = result(spark, str(tmp_path))
    want = plain(rows)
    assert got == want and got[dropped][-2:] == ("", hashlib.sha256().hexdigest())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(spark, str(tmp_path)) == {}
