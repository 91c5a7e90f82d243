"""Fits run at once only while the executors can keep the rows of all of them."""

import threading

import pytest

from bidlens import session
from bidlens.session import side_by_side


def most_at_once(table):
    running, counts, lock = [], [], threading.Lock()

    def job():
        with lock:
            running.append(1)
            counts.append(len(running))
        threading.Event().wait(0.5)
        with lock:
            running.pop()

    side_by_side(table, [job] * 4)
    return max(counts)


def test_storage_is_that_of_the_executors(spark):
    # 60 % of the heap without 300 MB
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert session._storage_bytes(spark) == pytest.approx(0.6 * (heap - (300 << 20)), rel=0.02)


@pytest.mark.parametrize("share, most", [(4, 4), (2, 2), (1, 1), (0.1, 1)])
def test_fits_whose_rows_do_not_fit_wait(spark, monkeypatch, share, most):
    monkeypatch.setattr(session, "_storage_bytes", lambda spark: int(share * 1000 * session.FIT_ROW_BYTES))
    assert most_at_once(spark.range(0, 1000, 1, 4)) == most
