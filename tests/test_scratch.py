"""Folders that runs leave in the shared checkpoint folder: swept by age, those in use aside."""

import os
import time

from quillmart import session
from quillmart.session import scratch_dir, sweep
from quillmart.sources.files import listing


def aged(base, name, hours, file=False):
    path = f"{base.removeprefix('file:')}/{name}"
    if file:
        open(path, "w").close()
    else:
        os.makedirs(path)
        open(f"{path}/part-0.parquet", "w").close()
    old = time.time() - hours * 3600
    os.utime(path, (old, old))


def test_old_folders_go_and_others_stay(spark):
    base = scratch_dir(spark, "probe").rsplit("/", 1)[0]
    gone = ["stored-0123456789ab", "mart-rows-00ff00ff00ff", "3f0e2a64-9a51-4c1e-8f56-0a4be1d2c3f4"]
    stay = ["tables", "stored-notes", "Stored-0123456789ab", "stored-0123456789abcd"]
    for name in gone + stay:
        aged(base, name, 200)
    aged(base, "stored-aaaaaaaaaaaa", 2)
    aged(base, "stored-bbbbbbbbbbbb", 200, file=True)
    mine = scratch_dir(spark, "stored").rsplit("/", 1)[-1]
    aged(base, mine, 200)
    assert sorted(sweep(spark)) == sorted(gone)
    assert {*stay, mine, "stored-aaaaaaaaaaaa", "stored-bbbbbbbbbbbb"} <= set(listing(spark, base))
    assert sweep(spark) == [] and sweep(spark, hours=1) == ["stored-aaaaaaaaaaaa"]


def test_number_of_folders_stays_bounded_over_many_runs(spark, monkeypatch):
    base, kept = scratch_dir(spark, "probe").rsplit("/", 1)[0], []
    frame = spark.range(5)
    for run in range(20):
        monkeypatch.setattr(session, "_MADE", set())  # a run is a process of its own
        sweep(spark, hours=24)
        path = scratch_dir(spark, "nightly")
        frame.write.parquet(path)
        assert spark.read.parquet(path).count() == 5
        for name in listing(spark, base):
            if name.startswith("nightly-"):  # half a day goes by
                folder = f"{base.removeprefix('file:')}/{name}"
                then = os.stat(folder).st_mtime - 12 * 3600
                os.utime(folder, (then, then))
        kept.append(sum(n.startswith("nightly-") for n in listing(spark, base)))
    assert max(kept) <= 3
