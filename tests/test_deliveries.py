"""Files that the catalog delivers to itself: loaded whole, and gone once the lake has their rows."""

import catalog.derived as d
import pytest

from tallyhouse.sources.lake import Lake


@pytest.fixture
def part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(d, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    rows = [(i, f"name {i}", "Brand#1", "STEEL", i, 10.5) for i in range(1, 8)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{tmp_path}/sf/part.parquet")
    return tmp_path


@pytest.mark.parametrize("load", [d.ingested, lambda spark, sf_dir, entity: d.ingested_in_turn(spark, sf_dir, (entity,))])
def test_delivered_files_go_once_they_are_loaded(spark, part, load):
    lake = load(spark, f"{part}/sf", "products")
    assert not (part / "landing").exists()
    assert sorted(r.product_name.strip() for r in lake.raw("products").collect()) == [f"name {i}" for i in range(1, 8)]
    assert {r.status for r in lake.source_files().collect()} == {"loaded"}


def test_files_of_a_batch_that_fails_stay(spark, part, monkeypatch):
    def broken(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(d, "run_batch", broken)
    with pytest.raises(RuntimeError):
        d.ingested(spark, f"{part}/sf", "products")
    assert list((part / "landing" / "products").glob("*.csv"))


def test_raw_rows_are_stored_small(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    lake.append(spark.range(10), "raw", "x")
    assert list((tmp_path / "lake" / "raw" / "x").glob("*.zstd.parquet"))
