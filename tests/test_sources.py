"""Named arrays, the export sink and the target store: slices, atomic commits, fingerprints."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from popforge.plans.construct import CONTENT
from popforge.sources import arrays, files, manifests, registry, target_store

N, H = 1000, 300


@pytest.fixture(scope="module")
def survey(tmp_path_factory):
    """One file with arrays as long as there are persons, and as long as there are households."""
    rng = np.random.default_rng(0)
    held = {
        "person_id": np.arange(N),
        "age": rng.integers(0, 90, N, dtype=np.int32),
        "income": rng.normal(size=N),
        "employed": rng.random(N) < 0.5,
        "home": rng.integers(0, H + 20, N),
        "household_id": np.arange(H),
        "nation": rng.integers(0, 25, H, dtype=np.int16),
        "segment": np.array([random.Random(k).choice(["BUILDING", "MACHINERY", "é"]) for k in range(H)]),
        "weight": rng.random(H).astype(np.float32),
    }
    path = str(tmp_path_factory.mktemp("arrays") / "survey.npz")
    np.savez(path, **held)
    return path, held


def plain(held, names):
    return sorted(zip(*[held[n].tolist() for n in names], strict=True))


def test_slices_of_two_lengths(spark, survey):
    path, held = survey
    people = arrays.read_arrays(spark, path, "person_id", rows=150)
    assert people.columns == ["person_id", "age", "income", "employed", "home"] and people.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, people.collect())) == plain(held, people.columns)
    assert people.dtypes == [("person_id", "bigint"), ("age", "int"), ("income", "double"), ("employed", "boolean"), ("home", "bigint")]
    homes = arrays.read_arrays(spark, path, "household_id", columns=["household_id", "segment", "weight"], rows=128)
    assert homes.rdd.getNumPartitions() == 3 and sorted(map(tuple, homes.collect())) == plain(held, homes.columns)


def test_only_the_arrays_asked_for_are_read(spark, survey, monkeypatch):
    path, held = survey
    reader = arrays.ArraysReader(arrays.NamedArrays({"path": path, "table": "age", "columns": "age"}).schema(), {"path": path, "table": "age", "columns": "age"})
    (part,) = reader.partitions()
    (batch,) = reader.read(arrays.Slice(part.path, 10, 15))
    assert batch.to_pydict() == {"age": held["age"][10:15].tolist()}


def test_household_rows_equal_the_plain_loader(spark, survey):
    path, held = survey
    people, homes = arrays.read_arrays(spark, path, "person_id", rows=300), arrays.read_arrays(spark, path, "household_id", rows=100)
    got = registry.household_rows(people, homes, "home", "household_id", {"state": "nation", "w": "weight"})
    want = [(p, a, int(held["nation"][h]) if h < H else None, float(held["weight"][h]) if h < H else None) for p, a, h in zip(held["person_id"].tolist(), held["age"].tolist(), held["home"].tolist(), strict=True)]
    assert sorted(map(tuple, got.select("person_id", "age", "state", "w").collect())) == sorted(want)
    block = manifests.load_blocks((CONTENT / "blocks.json").read_text())["homes"]
    built = block.build(people.withColumnRenamed("home", "household_id"), homes)
    frame = block.model_frame(built)
    assert frame.count() == N and frame.where("tenure is null and household_id < 300").count() == sum(1 for h in held["home"].tolist() if h < H and held["segment"][h] == "é")


def test_periods_and_what_is_no_table(spark, tmp_path):
    path = str(tmp_path / "periods.npz")
    np.savez(path, **{"pay/2023": np.arange(3), "pay/2024": np.arange(3, 6), "id/2024": np.arange(3)})
    assert sorted(map(tuple, arrays.read_arrays(spark, path, "id", period="2024").collect())) == [(3, 0), (4, 1), (5, 2)]
    np.savez(str(tmp_path / "two.npz"), a=np.arange(3), b=np.arange(4))
    np.savez_compressed(str(tmp_path / "small.npz"), a=np.arange(3))
    np.savez(str(tmp_path / "flat.npz"), a=np.zeros((2, 2)))
    np.savez(str(tmp_path / "complex.npz"), a=np.zeros(2, complex))
    np.savez(str(tmp_path / "none.npz"), a=np.zeros(0), b=np.array([], "S1"))
    for name, options, part in [("two", {}, "lengths"), ("two", {"table": "c"}, "no array 'c'"), ("two", {"table": "a", "columns": "b"}, "no arrays"), ("small", {}, "compressed"), ("flat", {}, "one-dimensional"), ("complex", {}, "no column of type")]:
        with pytest.raises(arrays.ArraysError, match=part):
            arrays.NamedArrays({"path": str(tmp_path / f"{name}.npz"), **options}).schema()
    assert arrays.read_arrays(spark, str(tmp_path / "none.npz")).collect() == []


def test_export_and_reading_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    odd = spark.createDataFrame([(1, None, True, 0.5, None), (2, "", None, None, 7), (None, "Zoë\n", False, float("nan"), -1)], "id long, name string, flag boolean, x double, small int")
    many = spark.range(1000).select("id", F.concat(F.lit("n"), F.col("id")).alias("name")).repartition(5)
    found = arrays.export_population({"odd": odd, "many": many, "none": many.limit(0)}, path)
    assert {e: x["rows"] for e, x in found["entities"].items()} == {"odd": 3, "many": 1000, "none": 0}
    back = arrays.read_arrays(spark, path, "odd", verify=True)
    assert back.schema.simpleString() == odd.schema.simpleString() and sorted(map(repr, back.collect())) == sorted(map(repr, odd.collect()))
    read = arrays.read_arrays(spark, path, "many", columns=["name"], rows=50, verify=True)
    assert read.rdd.getNumPartitions() >= 20 and {r.name for r in read.collect()} == {f"n{k}" for k in range(1000)}
    assert arrays.read_arrays(spark, path, "none").collect() == []
    parts = [p for x in found["entities"].values() for p in x["parts"]]
    assert all(hashlib.sha256(open(f"{path}/{p['file']}", "rb").read()).hexdigest() == p["sha256"] for p in parts)
    prints = {r.path.split("/")[-1]: r.sha256 for r in registry.file_fingerprints(spark, f"{path}/{found['run']}/many").collect()}
    assert prints == {p["file"].split("/")[-1]: p["sha256"] for p in found["entities"]["many"]["parts"]}
    with pytest.raises(arrays.ArraysError, match="'lost'"):
        arrays.NamedArrays({"path": path, "table": "lost"}).schema()
    with open(f"{path}/{found['entities']['many']['parts'][0]['file']}", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="is not the file that was exported"):
        arrays.read_arrays(spark, path, "many", verify=True).count()


def test_a_lost_task_leaves_nothing_behind(spark, tmp_path):
    """An export whose third entity fails in one task commits nothing; the export before it stays as it was."""
    path = str(tmp_path / "out")
    good = spark.range(100).repartition(4)
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("executor lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="executor lost"):
        arrays.export_population({"household": good, "person": broken, "family": good}, path)
    assert not files.exists(f"{path}/{arrays.MANIFEST}") and [x for x in os.listdir(path) if x.startswith("run-")] == []
    with pytest.raises(arrays.ArraysError, match="no completed export"):
        arrays.NamedArrays({"path": path, "table": "household"}).schema()
    first = arrays.export_population({"household": good}, path)
    with pytest.raises(Exception, match="executor lost"):
        arrays.export_population({"household": good.limit(3), "person": broken}, path)
    assert arrays.manifest(path) == first and arrays.read_arrays(spark, path, "household", verify=True).count() == 100
    second = arrays.export_population({"household": good.limit(3)}, path)
    assert arrays.read_arrays(spark, path, "household").count() == 3 and len(files.folders(path)) == 2
    arrays.clean(path)
    assert files.folders(path) == [second["run"]]


def test_what_no_array_can_hold(spark):
    with pytest.raises(arrays.ArraysError, match="when: no array of type"):
        arrays.packed({"when": pa.array([0], pa.timestamp("us"))})
    with pytest.raises(arrays.ArraysError, match="zero byte"):
        arrays.packed({"name": pa.array(["a\0"])})


def test_target_store(spark, tmp_path):
    path = str(tmp_path / "targets.db")
    rows = [(f"t{k:03d}", k / 7 if k % 5 else None, k % 2 == 0, 2024, "state" if k % 3 else "national", None if k % 4 else "06") for k in range(230)]
    given = spark.createDataFrame(rows, "target_id string, value double, kept boolean, model_year int, geo_level string, state_fips string")
    sha = target_store.write_store(given, path)
    assert sha == hashlib.sha256(open(path, "rb").read()).hexdigest() == files.sha256(path, 100)
    found = target_store.read_store(spark, path, sha256=sha, rows=50)
    assert found.rdd.getNumPartitions() == 5 and sorted(map(tuple, found.collect()), key=repr) == sorted(rows, key=repr)
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "double", "boolean", "bigint", "string", "string"]
    assert target_store.write_store(given.repartition(7), str(tmp_path / "again.db")) == sha
    for at, options, part in [(path, {"sha256": "0" * 64}, "fingerprint"), (str(tmp_path / "gone.db"), {}, "no target store"), (path, {"table": "gone"}, "no table 'gone'")]:
        with pytest.raises(target_store.StoreError, match=part):
            target_store.TargetStore({"path": at, "table": "targets", **options}).schema()
    (tmp_path / "junk.db").write_bytes(b"junk" * 500)
    with pytest.raises(target_store.StoreError, match="no database"):
        target_store.opened(str(tmp_path / "junk.db"))
    target_store.write_store(given.limit(0), str(tmp_path / "none.db"))
    assert target_store.read_store(spark, str(tmp_path / "none.db")).collect() == []
    with pytest.raises(target_store.StoreError, match="no column of type"):
        target_store.write_store(given.select(F.array("target_id").alias("a")), str(tmp_path / "bad.db"))
    with open(path, "ab") as f:
        f.write(b"\0")
    with pytest.raises(Exception, match="fingerprint"):
        found.count()
