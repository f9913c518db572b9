import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows
from millrace.operators.keyed import KeyedTable, mentions
from millrace.session import scratch

ANIMALS = {"name": "string", "size": "string"}


@pytest.fixture
def animals(spark):
    return KeyedTable(spark, scratch(spark, "animals"), "id", "int", ANIMALS, buckets=4)


def put(table, epoch, *values, columns=("name", "size")):
    schema = "id int, " + ", ".join(f"{c} string" for c in columns)
    df = table.spark.createDataFrame(list(values), schema)
    for c in ANIMALS:
        if c not in columns:
            df = df.withColumn(c, F.lit(None).cast("string")).withColumn(mentions(c), F.lit(False))
    table.write(df, epoch)


def test_same_key_replaces_the_row(animals):
    put(animals, 0, (3, "Deer", "Big"), (5, "Snake", None), (11, "Cow", "Big"))
    put(animals, 1, (11, "Bull", "Big"))
    assert rows(animals.read()) == [(3, "Deer", "Big"), (5, "Snake", None), (11, "Bull", "Big")]
    assert rows(animals.read(up_to=0))[2] == (11, "Cow", "Big")


def test_unnamed_columns_stay_and_explicit_nulls_replace(animals):
    put(animals, 0, (3, "Deer", "Big"))
    put(animals, 1, (3, "Doe"), (5, "Snake"), columns=("name",))
    assert rows(animals.read()) == [(3, "Doe", "Big"), (5, "Snake", None)]
    put(animals, 2, (3, None, None))
    assert rows(animals.read()) == [(3, None, None), (5, "Snake", None)]


def test_delete_then_insert_again(animals):
    put(animals, 0, (3, "Deer", "Big"), (5, "Snake", "Small"))
    animals.write(animals.spark.createDataFrame([(5, None, None)], "id int, name string, size string"), 1,
                  deleted=F.lit(True))
    assert rows(animals.read()) == [(3, "Deer", "Big")]
    put(animals, 2, (5, "Viper"), columns=("name",))
    assert rows(animals.read()) == [(3, "Deer", "Big"), (5, "Viper", None)]


def test_an_epoch_written_twice_counts_once(animals):
    put(animals, 0, (3, "Deer", "Big"))
    put(animals, 1, (3, "Doe", "Big"), (4, "Fox", "Small"))
    before = rows(animals.read())
    put(animals, 1, (3, "Doe", "Big"), (4, "Fox", "Small"))
    assert rows(animals.read()) == before and animals.slices().count() == 3


def test_lookup_reads_one_bucket_and_filters_in_the_scan(animals):
    put(animals, 0, *[(i, f"n{i}", "s") for i in range(40)])
    found = animals.lookup(7)
    assert rows(found) == [(7, "n7", "s")]
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: \[.*bucket", plan) and "EqualTo(id,7)" in plan
    keys = animals.spark.createDataFrame([(1,), (39,), (39,), (77,)], "id int")
    assert rows(animals.rows_of(keys)) == [(1, "n1", "s"), (39, "n39", "s")]
    assert animals.read().filter("size = 's'").count() == 40


def test_replace_and_compact_move_readers(animals, spark):
    put(animals, 0, (3, "Deer", "Big"), (5, "Snake", "Small"), (8, "Ant", "Small"))
    put(animals, 1, (3, "Doe"), columns=("name",))
    animals.write(spark.createDataFrame([(8, None, None)], "id int, name string, size string"), 1, deleted=F.lit(True))
    remove = spark.createDataFrame([(8, None, None)], "id int, name string, size string")
    animals.write(remove, 2, deleted=F.lit(True))
    put(animals, 3, (5, "Viper"), columns=("name",))
    other = KeyedTable(spark, animals.path, "id", "int", ANIMALS, buckets=4)
    before, looked_up = other.read(), other.lookup(8)
    now = rows(animals.read())
    animals.compact(up_to=2)
    # The removed row has left no trace in the base; the later epoch is the old folder.
    state = other.state()
    assert state["base"] == 2 and sorted(state["slices"]) == ["2", "3"]
    assert other.slices(up_to=2).where("id = 8").count() == 0 and other.slices(up_to=2).where("_deleted is not null").count() == 0
    assert rows(before) == rows(other.read()) == now and rows(looked_up) == rows(other.lookup(8)) == []
    put(animals, 1, (3, "Moose", "Huge"))  # an epoch of the base again: the base has it already
    assert rows(other.read()) == now
    animals.replace(spark.createDataFrame([(11, "Bull", "Big")], "id int, name string, size string"), 4)
    assert rows(before) == now and rows(other.read()) == rows(other.lookup(11, 3)) == [(11, "Bull", "Big")]
    put(animals, 5, (12, "Calf", "Small"))
    assert len(rows(other.read())) == 2


def test_two_writers_cannot_make_the_same_version(animals, spark):
    put(animals, 0, (3, "Deer", "Big"))
    version, state = animals.manifest.latest()
    assert animals.manifest.put(version + 1, {**state, "note": "first"})
    assert not animals.manifest.put(version + 1, {**state, "note": "second"})
    calls = []

    def change(now):  # another writer comes in between, once
        calls.append(now)
        if len(calls) == 1:
            animals.manifest.put(version + 2, {**now, "note": "meanwhile"})
        return {**now, "mine": True}

    assert animals.manifest.change(change) == {**state, "note": "meanwhile", "mine": True} and len(calls) == 2
    assert animals.manifest.latest() == (version + 3, {**state, "note": "meanwhile", "mine": True})


def test_old_versions_of_the_manifest_go(animals, monkeypatch):
    monkeypatch.setattr("millrace.operators.manifest.KEPT", 3)
    for n in range(6):
        animals.manifest.change(lambda _, n=n: {"buckets": 4, "base": None, "slices": {}, "n": n})
    assert len(animals.manifest._versions()) == 3 and animals.manifest.latest()[1]["n"] == 5
    assert rows(animals.read()) == []


change = st.tuples(st.integers(0, 2), st.sampled_from(["put", "name", "size", "null", "delete"]), st.integers(0, 99))


@settings(max_examples=6, deadline=None)
@given(st.lists(change, min_size=1, max_size=14), st.integers(1, 3))
def test_any_changes_in_any_epochs(spark, changes, epochs):
    expected, made = {}, []
    for step, (key, kind, n) in enumerate(changes):
        name, size = (None, None) if kind == "null" else (f"n{n}", f"s{n}")
        if kind == "delete":
            expected.pop(key, None)
        else:
            old = expected.get(key, (None, None))
            expected[key] = (name if kind != "size" else old[0], size if kind != "name" else old[1])
        made.append((key, step, name, size, kind != "size", kind != "name", kind == "delete"))
    table = KeyedTable(spark, scratch(spark, "any"), "id", "int", ANIMALS, buckets=2)
    df = spark.createDataFrame(made, "id int, step int, name string, size string, set_name boolean, set_size boolean, gone boolean")
    span = -(-len(made) // epochs)
    for e in range(epochs):
        table.write(df.filter((F.col("step") >= e * span) & (F.col("step") < (e + 1) * span)), e, "step", F.col("gone"))
    assert {r["id"]: (r["name"], r["size"]) for r in table.read().collect()} == expected


def test_another_bucket_count_is_refused(spark):
    table = KeyedTable(spark, scratch(spark, "counted"), "id", "int", ANIMALS, buckets=8)
    table.write(spark.createDataFrame([(i, f"n{i}", "Big") for i in range(100)], "id int, name string, size string"), 0)
    other = KeyedTable(spark, table.path, "id", "int", ANIMALS, buckets=9)
    for use in (other.read, lambda: other.lookup(3), lambda: other.write(spark.createDataFrame([(1, "x", "y")], "id int, name string, size string"), 1)):
        with pytest.raises(ValueError, match="8 buckets"):
            use()
    assert other.opened().lookup(*range(20)).count() == 20 and other.opened().read().count() == 100
