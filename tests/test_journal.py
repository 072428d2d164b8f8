"""Runs that are broken off, and the journal that the next run goes on from."""

import os
from collections import Counter

import pytest

from heirloom.operators import journal as J


def prompts(spark, n, text="say"):
    return spark.createDataFrame([(f"c{i}", f"{text} {i}", i) for i in range(n)], "candidate_id string, prompt string, extra int")


def asker(log, dies_at=()):
    """A model that writes down what it is asked, fails for some numbers, and takes its worker with it for others."""

    def ask(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        no = int(prompt.split()[1])
        if no in dies_at:
            os._exit(7)
        if no % 10 == 3:
            raise TimeoutError("slow")
        return '{"no": %d}' % no if no % 10 else "no json"

    return ask


def test_a_killed_run_asks_nobody_twice(spark, tmp_path):
    folder, first, second = (str(tmp_path / x) for x in ("journal", "first", "second"))
    rows = prompts(spark, 200)
    with pytest.raises(Exception, match="Job aborted|crashed|failed"):
        J.ask(rows, asker(first, dies_at=(150,)), folder, rows_per_task=5)
    kept = {r.candidate_id for r in J.read_journal(spark, folder).collect()}
    assert 0 < len(kept) < 200
    found = J.ask(rows, asker(second), folder, rows_per_task=5)
    again = {x.split()[1] for x in open(second).read().splitlines()}
    assert not again & {c[1:] for c in kept} and len(again) + len(kept) == 200
    got = {r.candidate_id: r for r in found.collect()}
    assert len(got) == 200 and found.columns == ["candidate_id", "prompt", "extra", "raw_output", "parsed", "parse_status", "error"]
    assert Counter(r.parse_status for r in got.values()) == {"parsed": 160, "invalid_json": 20, "error": 20} and got["c7"].parsed == '{"no": 7}'
    # A third run has nothing to ask; one that asks again for failures asks for these alone.
    J.ask(rows, asker(tmp_path / "third"), folder).count()
    assert not (tmp_path / "third").exists()
    J.ask(rows, asker(tmp_path / "fourth"), folder, retry_errors=True, threads=4).count()
    assert Counter(open(tmp_path / "fourth").read().splitlines()) == {f"say {i}": 1 for i in range(3, 200, 10)}


def test_changed_prompts_repeated_rows_and_waves(spark, tmp_path):
    folder, log = str(tmp_path / "journal"), tmp_path / "log"
    rows = prompts(spark, 30)
    found = J.ask(rows.union(rows), asker(log), folder, rows_per_task=4, tasks=2, threads=3).collect()
    assert len(found) == 60 and Counter(open(log).read().splitlines()) == {f"say {i}": 1 for i in range(30)}
    J.ask(prompts(spark, 30, "tell"), asker(tmp_path / "b"), folder)
    J.ask(rows, asker(tmp_path / "c"), folder, model="other")
    assert len(open(tmp_path / "b").read().splitlines()) == len(open(tmp_path / "c").read().splitlines()) == 30
    assert J.ask(rows.where("false"), asker(log), str(tmp_path / "none")).collect() == []


def test_an_entry_that_is_there_twice_counts_once(spark, tmp_path):
    folder = str(tmp_path / "journal")
    rows = prompts(spark, 8)
    J.ask(rows, asker(tmp_path / "a"), folder)
    J.read_journal(spark, folder).write.json(f"{folder}-copy")
    spark.read.schema(J.SCHEMA).json(f"{folder}-copy").write.mode("append").json(folder)
    assert J.read_journal(spark, folder).count() == 16 and J.ask(rows, asker(tmp_path / "b"), folder).count() == 8 and not (tmp_path / "b").exists()
