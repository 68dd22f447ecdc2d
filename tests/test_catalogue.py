"""Finished folders and their schemas, without a driver call per folder."""

import pytest
from pyspark.sql import functions as F

from phenoloom.operators import results
from phenoloom.sources import catalogue


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """A thousand folders in two schemas; every tenth is not finished."""
    import pyarrow as pa
    from pyarrow import parquet

    root = tmp_path_factory.mktemp("many folders")
    for k in range(1000):
        place = root / f"p{k}" / "variant_results"
        place.mkdir(parents=True)
        value = pa.array([k], pa.int32()) if k % 2 else pa.array([k / 2], pa.float64())
        columns = {"pos": pa.array([k], pa.int64()), "value": value}
        if k % 2:
            columns["extra"] = pa.array(["x"])
        parquet.write_table(pa.table(columns), place / "part-0.parquet")
        if k % 10:
            (place / "_SUCCESS").write_text("")
    return str(root)


def test_thousand_folders_two_leaves(spark, many, monkeypatch):
    calls = []
    plain = catalogue.matching_paths
    monkeypatch.setattr(catalogue, "matching_paths", lambda s, p: calls.append(p) or plain(s, p))
    done = catalogue.finished_outputs(spark, f"{many}/*")
    assert len(done) == 900 and len(calls) == 1
    listed = catalogue.finished_outputs(spark, [f"{many}/p{k}" for k in range(1000)])
    assert len(listed) == 900 and len(calls) == 2
    reads = []
    reader = type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **o: reads.append(len(paths)) or parquet(self, *paths, **o))
    union = catalogue.read_and_union(spark, done)
    assert sorted(reads)[-2:] == [400, 500] and len(reads) <= 4  # the staged catalogue, and a scan per schema
    plan = union._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert dict(union.dtypes) == {"pos": "bigint", "value": "double", "extra": "string"}
    assert union.agg(F.sum("value"), F.count("extra")).first()[:] == (sum(k if k % 2 else k / 2 for k in range(1000) if k % 10), 500)


def test_declared_fields_need_one_scan(spark, many):
    union = catalogue.read_and_union(spark, f"{many}/*/variant_results", "pos long, value double, extra string")
    assert union._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert union.agg(F.count("*"), F.sum("value")).first()[:] == (1000, sum(k if k % 2 else k / 2 for k in range(1000)))
    assert catalogue.read_and_union(spark, [], "pos long").count() == 0


def test_one_footer_a_folder(spark, many):
    found = catalogue.schema_catalogue(spark, [f"{many}/p{k}/variant_results" for k in range(4)]).collect()
    assert [r["folder"].rsplit("/", 2)[1] for r in sorted(found)] == ["p0", "p1", "p2", "p3"]
    assert len({r["schema"] for r in found}) == 2
    assert catalogue._footer("nowhere://x/y.parquet") is None


def test_nothing_to_read(spark, tmp_path):
    assert catalogue.finished_outputs(spark, f"{tmp_path}/*") == [] and catalogue.finished_outputs(spark, []) == []
    (tmp_path / "a").mkdir()
    with pytest.raises(ValueError):
        catalogue.read_and_union(spark, str(tmp_path / "a"))


def test_strict_phenotypes(spark):
    found = spark.createDataFrame([(1, "a"), (2, "b")], "pos int, code string")
    known = spark.createDataFrame([("a", 5)], "code string, n int")
    assert {tuple(r) for r in results.union_with_phenotypes(found, known, ["code"]).select("pos", "n").collect()} == {(1, 5), (2, None)}
    assert results.union_with_phenotypes(found.limit(1), known, ["code"], strict=True).count() == 1
    with pytest.raises(Exception, match="no phenotype for b"):
        results.union_with_phenotypes(found, known, ["code"], strict=True).collect()
