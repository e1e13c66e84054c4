"""The file-skipping index: never a missed row, and few files opened on the Z-ordered fact."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from urbanpulse.operators import skip_index as X
from urbanpulse.operators.skip_index import Predicate
from urbanpulse.plans import extra
from urbanpulse.plans.lakehouse import Lakehouse


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def z_fact(spark):
    path, index = extra.z_ordered_fact(Lakehouse(spark, SF_ORACLE))
    return spark.read.parquet(path), path, index


def test_files_opened(spark, z_fact):
    """Road and zone: a share of the files near their share of the rows; a vehicle: Bloom bits beat the bounds."""
    stored, path, index = z_fact
    found = X.lookup(stored, path, index, [Predicate("road_id", "=", "R300"), Predicate("city_zone", "=", "HARBOR")])
    assert found.files >= 12 and found.opened <= 0.3 * found.files
    assert rows(found.rows) == rows(stored.where("road_id = 'R300' and city_zone = 'HARBOR'"))
    assert len(found.rows.inputFiles()) == found.opened
    vehicle = stored.groupBy("vehicle_id").count().orderBy("count", "vehicle_id").first()[0]
    by_bounds = X.candidates(spark, index, [Predicate("vehicle_id", ">=", vehicle), Predicate("vehicle_id", "<=", vehicle)]).count()
    by_bits = X.candidates(spark, index, [Predicate("vehicle_id", "=", vehicle)]).count()
    holding = len(stored.where(F.col("vehicle_id") == vehicle).select(F.input_file_name()).distinct().collect())
    assert holding <= by_bits < by_bounds and by_bits <= holding + 3


def test_no_row_is_missed(spark, z_fact):
    stored, path, index = z_fact
    values = [r[0] for r in stored.select("vehicle_id").distinct().orderBy("vehicle_id").limit(12).collect()]
    newest = stored.agg(F.max("event_ts")).first()[0]
    asked = [[Predicate("vehicle_id", "=", v)] for v in values] + [
        [Predicate("vehicle_id", "in", values[:3]), Predicate("road_id", "in", ["R100", "R500"])],
        [Predicate("event_ts", "<", newest)], [Predicate("event_ts", ">=", newest)], [Predicate("event_ts", ">", newest)],
        [Predicate("road_id", "between", ("R100", "R200"))], [Predicate("speed_kmh", "<=", 20)],
        [Predicate("vehicle_id", "=", "nobody")], [Predicate("vehicle_id", "in", [])], [Predicate("road_id", "=", None)]]
    for predicates in asked:
        found = X.lookup(stored, path, index, predicates, max_share=1.0)
        want = stored
        for p in predicates:
            want = want.where(p.on(F.col(p.column)))
        assert rows(found.rows) == rows(want), predicates
        assert found.rows.columns == stored.columns
    few = X.lookup(stored, path, index, [Predicate("vehicle_id", "=", values[0])], max_files=0)
    assert few.opened == few.files and rows(few.rows) == rows(stored.where(F.col("vehicle_id") == values[0]))


def test_nulls_types_and_partitions(spark, scratch_dir):
    """Null columns, dates, numbers and partition folders."""
    path, index = f"{scratch_dir}/t", f"{scratch_dir}/i"
    data = [(k, None if k % 3 == 0 else f"é{k}", None, date(2024, 1, 1 + k % 4), k % 4) for k in range(400)]
    (spark.createDataFrame(data, "id long, name string, empty string, day date, part int")
     .repartition(8, "id").write.partitionBy("part").parquet(path))
    stored = spark.read.parquet(path)
    X.write_index(stored, index, ["id", "name", "empty", "day"], ["id", "name", "empty"], values_per_file=10_000)
    assert spark.read.parquet(f"{index}/blooms").select("blocks").first()[0] == X.blocks_for(10_000) == 4
    for p in (Predicate("id", "=", 77), Predicate("name", "=", "é77"), Predicate("empty", "=", "x"),
              Predicate("day", "=", date(2024, 1, 2)), Predicate("part", "=", 2), Predicate("name", "in", ["é1", "é2", "zz"])):
        found = X.lookup(stored, path, index, [p], max_share=1.0)
        assert rows(found.rows) == rows(stored.where(p.on(F.col(p.column)))), p
    assert X.lookup(stored, path, index, [Predicate("empty", "=", "x")]).opened == 0
    assert X.lookup(stored, path, index, [Predicate("id", "=", 77)]).opened == 1


def test_empty_table(spark, scratch_dir):
    path, index = f"{scratch_dir}/t", f"{scratch_dir}/i"
    spark.createDataFrame([], "id long, name string").write.parquet(path)
    stored = spark.read.parquet(path)
    X.write_index(stored, index, ["id"], ["id"])
    assert X.lookup(stored, path, index, [Predicate("id", "=", 1)]).rows.count() == 0
