"""Files with a deadline each: slow, stubborn, dying and failing parsers beside good ones."""

import os
import signal
import subprocess
import time

from heirloom.sources import parsed, supervised


def parse(path, out):
    kind = path.split("-")[0]
    if kind == "slow":
        time.sleep(60)
    if kind == "stubborn":
        signal.signal(signal.SIGTERM, signal.SIG_IGN)
        time.sleep(60)
    if kind == "dies":
        os._exit(7)
    if kind == "parent":
        open(out, "w").write(str(subprocess.Popen(["sleep", "60"]).pid))
        time.sleep(60)
    if kind == "bad":
        raise ValueError("x" * 300_000)  # more than a pipe holds
    if kind == "quiet":
        raise KeyError


def test_each_call_in_order(tmp_path):
    kinds = ["ok", "slow", "bad", "quiet", "dies", "stubborn", "ok", "ok"]
    began = time.monotonic()
    found = list(supervised.each(parse, [(f"{k}-{i}", "") for i, k in enumerate(kinds)], 1.5, 3))
    took = time.monotonic() - began
    late = (False, "timed out after 1.5 seconds")
    assert [f[:2] for f in found] == [(True, None), late, (False, "x" * 300_000), (False, "KeyError"), (False, "ended with exit code 7"), late, (True, None), (True, None)]
    assert took < 30 and all(f[2] < 15 for f in found)
    assert list(supervised.each(parse, [], 1)) == []


def test_what_a_call_started_ends_with_it(tmp_path):
    out = str(tmp_path / "pid")
    assert [f[:2] for f in supervised.each(parse, [("parent-0", out)], 1.5)] == [(False, "timed out after 1.5 seconds")]
    pid = int(open(out).read())
    for _ in range(50):
        try:
            if open(f"/proc/{pid}/stat").read().split()[2] == "Z":
                break
        except FileNotFoundError:
            break
        time.sleep(0.1)
    else:
        raise AssertionError("still there")


def test_a_reader_that_stops_leaves_no_children():
    import multiprocessing

    some = supervised.each(parse, [("ok-0", ""), ("slow-1", ""), ("slow-2", "")], 30, 3)
    assert next(some)[0]
    some.close()
    assert not multiprocessing.active_children()


def test_batch_with_deadline(spark):
    names = ["ok-0", "slow-1", "dies-2", "ok-3"]
    files = spark.createDataFrame([(n, "o") for n in names], "path string, out_dir string")
    # Tests are no module that workers can import; a nested function travels whole.
    def run(path, out):
        import os
        import time

        if path.startswith("slow"):
            time.sleep(60)
        if path.startswith("dies"):
            os._exit(3)

    rows = {r.path: (r.success, r.error) for r in parsed.run_batch(files, run, seconds=2).collect()}
    assert rows == {"ok-0": (True, None), "slow-1": (False, "timed out after 2 seconds"), "dies-2": (False, "ended with exit code 3"), "ok-3": (True, None)}
