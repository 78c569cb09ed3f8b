"""Trusted orders from one day's increment and the newest rows kept: equal to all raw days together."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest

from compare import spark_rows
from daylake import plans, sources
from daylake.plans import incremental
from daylake.sources import commits

DAYS = [dt.date(2020, 7, d) for d in range(18, 23)]
ORDER = "order_id string, customer_id string, merchant_id string, order_created_at string, cpf string, note string"
STATUS = "order_id string, created_at string, value string"
CONSUMER = "customer_id string, created_at string, customer_phone_number string"
MERCHANT = "id string, created_at string, name string"


def random_day(rng, n):
    """Orders, statuses, consumers and merchants of which many belong to other days, repeat, tie or have nulls."""

    def pick(letter, most, null=0.05):
        return None if rng.random() < null else f"{letter}{rng.randrange(most)}"

    def at():
        return None if rng.random() < 0.05 else f"2020-07-{rng.randint(1, 9):02d}T00:00:00.000Z"

    return {
        "order": (ORDER, [(pick("o", 40), pick("c", 12), pick("m", 8), at(), f" {rng.randrange(3)} ", pick("n", 2)) for _ in range(n)]),
        "status": (STATUS, [(pick("o", 40), at(), rng.choice(["REGISTERED", "PLACED", "CONCLUDED"])) for _ in range(n)]),
        "consumer": (CONSUMER, [(pick("c", 12), at(), str(rng.randrange(9))) for _ in range(n // 5)]),
        "restaurant": (MERCHANT, [(pick("m", 8), at(), pick("r", 3)) for _ in range(n // 8)]),
    }


def deliver(spark, zones, rows, day):
    for name, (ddl, values) in rows.items():
        df = spark.createDataFrame(values, ddl)
        plans.registry(spark, zones).declare(name, df.schema)
        sources.write_day(df, sources.zone_path(zones, "raw", name), day)


def zones_of(path):
    return {"raw": f"{path}/raw", "trusted": f"{path}/trusted"}


def trusted(spark, zones, day):
    return spark_rows(sources.scan(spark, f"{zones['trusted']}/order", day))


@pytest.mark.parametrize("seed", [1, 2])
def test_five_days_equal_the_full_run(spark, tmp_path, seed):
    rng, step, full = random.Random(seed), zones_of(tmp_path / "step"), zones_of(tmp_path / "full")
    for k, day in enumerate(DAYS):
        rows = random_day(rng, 40)
        deliver(spark, step, rows, day)
        deliver(spark, full, rows, day)
        mine = plans.refresh_orders(spark, step, day, "salt", incremental=True, files=1)
        all_days = plans.refresh_orders(spark, full, day, "salt", all_raw_days=True, files=1)
        assert mine[2:] == all_days[2:]
        if mine.written:
            assert trusted(spark, step, day) == trusted(spark, full, day)
        # The raw days that are in the state are never read again.
        for name in rows:
            shutil.rmtree(tmp_path / "step" / "raw" / name / f"partition_column={day}")


def test_old_states_are_forgotten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "KEPT_DAYS", 1)
    rng, step, full = random.Random(5), zones_of(tmp_path / "step"), zones_of(tmp_path / "full")
    for day in DAYS[:4]:
        rows = random_day(rng, 30)
        deliver(spark, step, rows, day)
        deliver(spark, full, rows, day)
        plans.refresh_orders(spark, step, day, "salt", incremental=True)
        for name in incremental.NAMES:
            table = f"{incremental.state_path(step, 'raw')}/{name}"
            assert len(commits.newest(spark, table).days) <= 2
            sources.vacuum(spark, table, keep=1, older_than=0)
    plans.refresh_orders(spark, full, DAYS[3], "salt", all_raw_days=True)
    assert trusted(spark, step, DAYS[3]) == trusted(spark, full, DAYS[3])


def test_only_what_is_new_is_read(spark, tmp_path):
    rng, zones, asked = random.Random(4), zones_of(tmp_path), []

    def advance(day):
        def read(days):
            asked.append(days)
            raw = {n: read_(spark, f"{zones['raw']}/{n}", days, plans.registry(spark, zones).schema(n)) for n, read_ in plans.jobs.READ_RAW.items()}
            return incremental.Newest(**raw)

        incremental.advance(spark, incremental.state_path(zones, "raw"), day, read)

    for day in DAYS:
        deliver(spark, zones, random_day(rng, 20), day)
    advance(DAYS[0])
    advance(DAYS[1])
    # A missed day is caught up with, and a day that is run again starts from the state before it.
    advance(DAYS[3])
    advance(DAYS[3])
    assert asked == [
        sources.Days(None, DAYS[0]), sources.Days(DAYS[0], DAYS[1]), sources.Days(DAYS[1], DAYS[3]), sources.Days(DAYS[1], DAYS[3])
    ]


def test_catching_up_and_repeating_give_the_same(spark, tmp_path):
    rng, step, full = random.Random(6), zones_of(tmp_path / "step"), zones_of(tmp_path / "full")
    for day in DAYS:
        rows = random_day(rng, 40)
        deliver(spark, step, rows, day)
        deliver(spark, full, rows, day)
    for day in (DAYS[1], DAYS[1], DAYS[4], DAYS[4]):
        plans.refresh_orders(spark, step, day, "salt", incremental=True)
    plans.refresh_orders(spark, full, DAYS[4], "salt", all_raw_days=True)
    assert trusted(spark, step, DAYS[4]) == trusted(spark, full, DAYS[4])


def test_a_state_that_was_cut_short_is_made_again(spark, tmp_path):
    rng, step, full = random.Random(7), zones_of(tmp_path / "step"), zones_of(tmp_path / "full")
    days = [random_day(rng, 40) for _ in DAYS[:3]]
    for day, rows in zip(DAYS, days):
        deliver(spark, step, rows, day)
        deliver(spark, full, rows, day)
    plans.refresh_orders(spark, step, DAYS[0], "salt", incremental=True)
    # The second day's run ends after it has kept the consumers alone.
    base = incremental.state_path(step, "raw")
    table = f"{base}/consumer"
    none = spark.createDataFrame([], commits.newest(spark, table).schema)
    commits.promote(spark, commits.stage(none, table, DAYS[1]))
    plans.refresh_orders(spark, step, DAYS[2], "salt", incremental=True)
    plans.refresh_orders(spark, full, DAYS[2], "salt", all_raw_days=True)
    assert trusted(spark, step, DAYS[2]) == trusted(spark, full, DAYS[2])


def test_other_keys(spark, tmp_path):
    rng, step, full = random.Random(8), zones_of(tmp_path / "step"), zones_of(tmp_path / "full")
    options = {"key": "merchant_id", "hashed": ["cpf", "note"]}
    for day in DAYS[:3]:
        rows = random_day(rng, 40)
        deliver(spark, step, rows, day)
        deliver(spark, full, rows, day)
        plans.refresh_orders(spark, step, day, "salt", incremental=True, **options)
        plans.refresh_orders(spark, full, day, "salt", all_raw_days=True, **options)
    assert trusted(spark, step, DAYS[2]) == trusted(spark, full, DAYS[2])
    with pytest.raises(ValueError):
        plans.refresh_orders(spark, step, DAYS[2], "salt", incremental=True, all_raw_days=True)


def test_the_whole_job_runs_incrementally(spark, tmp_path):
    rng, zones = random.Random(9), zones_of(tmp_path)
    cart = '[{"name": "i", "garnishItems": [{"externalId": "G"}]}]'
    for day in DAYS[:2]:
        rows = random_day(rng, 40)
        ddl, values = rows["order"]
        rows["order"] = (f"{ddl}, items string", [(*v, cart) for v in values])
        deliver(spark, zones, rows, day)
        gates = plans.refresh_trusted(spark, zones, day, "salt", incremental=True)
        assert [g.dataset for g in gates] == ["order", "order_items", "order_statuses"]
        kind = plans.items_schema(spark, zones, day)
        assert kind.simpleString() == "array<struct<garnishItems:array<struct<externalId:string>>,name:string>>"
    kept = tmp_path / "trusted" / "_schemas" / "order.items"
    assert sorted(p.name for p in kept.glob("*.ddl")) == [f"{day}.ddl" for day in DAYS[:2]]
