import os
import random

from pyspark.sql import functions as F

from flowwarden.sources import sweep as Sw
from flowwarden.sources.inventory import file_inventory
from flowwarden.sources.state import StateTable
from tests.conftest import rows

SCHEMA = "ip string, n bigint, note string"


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def buckets(spark, ips, n):
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    return {r["ip"]: r["b"] for r in df.select("ip", F.pmod(F.xxhash64("ip"), F.lit(n)).cast("int").alias("b")).collect()}


def test_many_batches_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    state, want, history = StateTable(spark, str(tmp_path), SCHEMA, buckets=8), {}, {}
    assert state.read().count() == 0
    for version in range(12):
        changed = {f"10.0.0.{rng.randrange(20)}": (rng.randrange(100), rng.choice([None, "x"])) for _ in range(4)}
        gone = {f"10.0.0.{rng.randrange(20)}" for _ in range(2)} - changed.keys()
        up = spark.createDataFrame([(k, *v) for k, v in changed.items()], SCHEMA)
        out = spark.createDataFrame([(k,) for k in gone], "ip string")
        touched = state.apply(version, up, out)
        mine = buckets(spark, [*changed, *gone], 8)
        # Only the buckets of this batch have files of this version.
        assert touched == sorted(set(mine.values()))
        assert {f.split("/")[2] for f in files(str(tmp_path)) if f.startswith(f"log/version={version}/")} == {f"bucket={b}" for b in touched}
        if version == 5:
            state.apply(version, up, out)  # written again
        want = {k: v for k, v in {**want, **changed}.items() if k not in gone}
        history[version] = dict(want)
        if version in (4, 9):
            before = set(files(str(tmp_path)))
            heavy = state.compact(least=3)
            new = {f for f in set(files(str(tmp_path))) - before}
            assert heavy and {f.split("/")[2] for f in new} <= {f"bucket={b}" for b in heavy}
            assert all(f.startswith(f"snapshot/version={version}/") for f in new)
        assert rows(state.read()) == sorted(((k, *v) for k, v in want.items()), key=repr)
    assert rows(state.read(10)) == sorted(((k, *v) for k, v in history[10].items()), key=repr)
    assert state.compact(least=100) == []


def test_a_batch_without_rows_and_one_that_empties_a_bucket(spark, tmp_path):
    state = StateTable(spark, str(tmp_path), SCHEMA, buckets=2)
    one = spark.createDataFrame([("1.1.1.1", 1, "a")], SCHEMA)
    assert state.apply(0) == [] and state.read().count() == 0
    assert len(state.apply(1, one)) == 1
    state.apply(2, None, one.select("ip"))
    assert state.read().count() == 0 and len(state.compact(least=1)) == 1 and state.read().count() == 0
    state.apply(3, one)
    assert rows(state.read()) == [("1.1.1.1", 1, "a")]


def put(path, text="x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_moves_and_deletions_are_repeatable(spark, tmp_path):
    root = str(tmp_path / "data")
    for i in range(6):
        put(f"{root}/in/a{i}.csv", "x" * (i + 1))
        put(f"{root}/in/a{i}.pcap")
        os.utime(f"{root}/in/a{i}.csv", (1_700_000_000 + 60 * i,) * 2)
        os.utime(f"{root}/in/a{i}.pcap", (1_700_000_000 + 60 * i,) * 2)
    put(f"{root}/done/a5.csv", "already there")
    now = F.timestamp_seconds(F.lit(1_700_000_000 + 360))
    policies = [Sw.Policy("csv", f"{root}/in", ("*.csv",), 4), Sw.Policy("pcap", f"{root}/in", ("*.pcap",), 2), Sw.Policy("never", f"{root}/done")]
    plan = Sw.retention_plan(file_inventory(spark, f"{root}/in"), now, policies)
    assert rows(plan.groupBy("policy").count()) == [("csv", 2), ("pcap", 4)]
    journal = Sw.carry_out(plan, str(tmp_path / "j1"))
    counts = rows(Sw.sweep_counts(journal).select("policy", "action", "outcome", "files", "bytes"))
    assert counts == [("csv", "delete", "done", 2, 3), ("pcap", "delete", "done", 4, 4)]
    # The same plan once more finds its files gone.
    fixed = spark.read.parquet(str(tmp_path / "j1" / "plan"))
    again = Sw.carry_out(fixed, str(tmp_path / "j2"))
    assert rows(again.select("outcome").distinct()) == [("gone",)]
    moves = Sw.archive_plan(file_inventory(spark, f"{root}/in", "*.csv"), f"{root}/done")
    done = Sw.carry_out(moves, str(tmp_path / "j3"))
    assert sorted(os.listdir(f"{root}/in")) == ["a4.pcap", "a5.csv", "a5.pcap"]
    assert sorted(os.listdir(f"{root}/done")) == ["a2.csv", "a3.csv", "a4.csv", "a5.csv"]
    # A name that is taken is an error in the journal, and the file stays.
    assert rows(Sw.sweep_counts(done).select("outcome", "files")) == [("done", 3), ("error", 1)]
    assert Sw.retention_plan(file_inventory(spark, f"{root}/in"), now, []).count() == 0
    assert "no file system" in Sw.carry_out_one("strange://x/y", "delete", None) or Sw.carry_out_one("strange://x/y", "delete", None).startswith("error")
