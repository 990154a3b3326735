"""The commit log: numbered files that only one writer can create, and the fence over a load."""

import pytest

from fraudlane.plans.commits import CommitLog, Conflict, Fenced


def test_a_number_is_created_once_and_the_log_has_no_gap(spark, scratch):
    a, b = CommitLog(spark, f"{scratch}/log"), CommitLog(spark, f"{scratch}/log")
    assert a.entries() == [] and a.append({"load": 1}, expected=0) == 1
    with pytest.raises(Conflict):
        b.append({"load": 2}, expected=0)  # read the log before a's commit
    assert b.append({"load": 2}, expected=1) == 2
    assert a.entries() == b.entries() == [{"load": 1, "number": 1}, {"load": 2, "number": 2}]
    assert a.last() == 2


def test_a_later_claim_fences_off_the_earlier_writer(spark, scratch):
    log = CommitLog(spark, f"{scratch}/log")
    first = log.claim(7)
    log.check(7, first)
    second = log.claim(7)  # the load is started again
    assert second > first
    with pytest.raises(Fenced):
        log.check(7, first)
    log.check(7, second)
    assert log.claim(8) == 1  # another load's claims are its own


def test_unfinished_files_are_not_entries(spark, scratch):
    log = CommitLog(spark, f"{scratch}/log")
    log.append({"load": 1}, expected=0)
    with open(f"{scratch}/log/0000000002.json", "w") as f:
        f.write('{"lo')  # its writer has died
    assert log.entries() == [{"load": 1, "number": 1}] and log.append({"load": 2}, expected=log.last()) == 3
    assert [e["number"] for e in log.entries()] == [1, 3]
