"""The change feed of row versions: what each batch made of each row."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from lodestrata.schemas import BRONZE
from lodestrata.streaming import versions
from lodestrata.streaming.ingest import consume_changes
from tests.conftest import feed, money

MOMENT = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)


def order(key, status, amount="1.00"):
    return key, 7, MOMENT, status, "web", money(amount)


class Feed:
    """Drops of row versions and the changes that each run of the feed gave."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.batches = spark, tmp_path, []

    def drop(self, version, rows, gone=()):
        df = feed(self.spark, "orders", rows)
        before = df.unionByName(feed(self.spark, "orders", gone)) if gone else None
        versions.land_versions(df, f"{self.path}/in", version, before, "order_id")

    def run(self):
        found = []

        def keep(batch, number):
            found.extend(tuple(x) for x in batch.collect())

        stream = versions.net_changes(versions.row_versions(self.spark, f"{self.path}/in", "orders"), "order_id")
        consume_changes(stream, f"{self.path}/checkpoint", keep)
        return sorted((x[0], x[1], x[2], x[5]) for x in found), found


def test_three_drops_with_restarts(spark, tmp_path):
    source = Feed(spark, tmp_path)
    source.drop(1, [order(1, "a"), order(2, "b"), order(3, "c", None), (None, 1, None, "no key", None, None)])
    got, rows = source.run()
    assert got == [("INSERT", 1, 1, "a"), ("INSERT", 1, 2, "b"), ("INSERT", 1, 3, "c")]
    # Every value comes through, also fractions of a second, money and NULL.
    assert sorted(x[2:] for x in rows)[0] == order(1, "a") and sorted(x[2:] for x in rows)[2][-1] is None
    # The same, another, one more, and one gone.
    source.drop(2, [order(1, "a"), order(2, "B"), order(4, "d")], gone=[order(3, "c", None)])
    assert source.run()[0] == [("DELETE", 2, 3, "c"), ("INSERT", 2, 4, "d"), ("UPDATE", 2, 2, "B")]
    # One comes back; a late version of what is known changes nothing, nor does a drop that is sent twice.
    source.drop(3, [order(3, "again")])
    source.drop(1, [order(2, "late"), order(4, "late")])
    source.drop(2, [order(1, "a"), order(2, "B"), order(4, "d")])
    assert source.run()[0] == [("INSERT", 3, 3, "again")]
    assert source.run()[0] == []


def test_what_comes_and_goes_within_a_batch(spark, tmp_path):
    source = Feed(spark, tmp_path)
    source.drop(1, [order(1, "a"), order(2, "a")])
    source.drop(2, [order(2, "b")], gone=[order(1, "a")])
    source.drop(3, [order(2, "c")])
    assert source.run()[0] == [("INSERT", 3, 2, "c")]
    # What is gone stays gone when a late version of it comes.
    source.drop(1, [order(1, "late")])
    source.drop(4, [order(2, "x")])
    source.drop(5, [order(2, "c")])
    assert source.run()[0] == []


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_lead_from_one_state_to_the_next(spark, tmp_path, seed):
    rng, source, known = random.Random(seed), Feed(spark, tmp_path), {}
    for version in range(1, 5):
        now = {k: order(k, rng.choice("ab")) for k in range(30) if rng.random() < 0.7}
        source.drop(version, list(now.values()), gone=[known[k] for k in known if k not in now])
        want = [("INSERT", k, now[k][3]) for k in now if k not in known]
        want += [("UPDATE", k, now[k][3]) for k in now if k in known and known[k] != now[k]]
        want += [("DELETE", k, known[k][3]) for k in known if k not in now]
        assert [(a, k, s) for a, _, k, s in source.run()[0]] == sorted(want)
        known = now
    assert len(BRONZE["orders"]) == 6


class Store:
    """A state store that counts what it is asked."""

    def __init__(self):
        self.value, self.asked = None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value


def test_a_share_of_keys_asks_the_state_once():
    store, found = Store(), versions.LastVersions()
    found.init(store)

    def batch(*rows):
        store.asked = 0
        # Versions of one key may be in several parts.
        parts = [pd.DataFrame(rows[i::2], columns=["key", "number", "row"]) for i in range(2)]
        return sorted(tuple(x) for part in found.handleInputRows((0,), iter(parts), None) for x in part.values.tolist())

    assert len(batch(*[(k, 1, f"a{k}") for k in range(1000)])) == 1000 and store.asked == 2
    got = batch(*[(k, 2, f"a{k}") for k in range(2, 1000)], (0, 2, None), (1, 2, "b"), (1, 1, "late"), (2000, 2, None))
    assert got == [("DELETE", 2, "a0"), ("UPDATE", 2, "b")] and store.asked == 2
    assert batch((0, 1, "late"), (2000, 1, "late"), (1, 2, "b")) == [] and store.asked == 1
    # Of versions with one number the greatest text counts.
    assert batch((0, 3, "x"), (0, 3, "y"), (5, 2, None)) == [("INSERT", 3, "y")]


def test_shares_hold_many_keys(spark, tmp_path):
    rows = [order(k, "a") for k in range(50)]
    versions.land_versions(feed(spark, "orders", rows), f"{tmp_path}/in", 1)
    stream = versions.net_changes(versions.row_versions(spark, f"{tmp_path}/in", "orders"), "order_id", shares=3)
    found = []
    consume_changes(stream, f"{tmp_path}/checkpoint", lambda batch, number: found.extend(batch.collect()))
    assert sorted((x["action"], x["order_id"]) for x in found) == [("INSERT", k) for k in range(50)]
