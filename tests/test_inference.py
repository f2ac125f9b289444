"""Types inferred in one parse, against the reader's own inference."""

import pytest
from pyspark.sql import functions as F

from martworks.plans.testdata import ALL_TABLES, load
from martworks.sources import readers
from martworks.sources.inference import read_csv_inferred
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("table", [t for t in ALL_TABLES if t not in ("documents", "pages", "conversations", "benchmark")])
def test_types_and_rows_of_the_given_tables(spark, tmp_path, table):
    df = load(spark, SF_SMALL, table)
    flat = df.select(*[F.col(f.name) if "array" not in f.dataType.simpleString() else F.to_json(f.name).alias(f.name) for f in df.schema])
    path = str(tmp_path / table)
    flat.write.option("header", "true").csv(path)
    got, want = read_csv_inferred(spark, path), readers.read_csv(spark, path, infer=True)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


CASES = {
    "int": ["1", "-2", "+3", ""],
    "bigint": ["1", "99999999999"],
    "double": ["1", "2.5", "1e3", "NaN"],
    "date": ["2024-01-31", "2023-12-01"],
    "timestamp": ["2024-01-31", "2024-01-31 10:00:00"],
    "timestamp2": ["2024-01-31T10:00:00Z", "2024-01-31 10:00:00.5"],
    "boolean": ["true", "False"],
    "text": ["1", "a"],
    "mixed": ["1", "true"],
    "dates and numbers": ["2024", "2024-01-01"],
    "bad date": ["2024-02-30", "2024-01-01"],
    "nothing": ["", ""],
}


def test_types_of_small_columns(spark, tmp_path):
    for name, values in CASES.items():
        path = tmp_path / name.replace(" ", "_")
        path.mkdir()
        (path / "x.csv").write_text("k,v\n" + "".join(f"x,{v}\n" for v in values))
        got = read_csv_inferred(spark, str(path))
        want = readers.read_csv(spark, str(path), infer=True)
        assert got.dtypes == want.dtypes, name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_a_line_with_another_number_of_fields_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_inferred(spark, str(tmp_path)).collect()


def test_the_files_are_parsed_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4\n")
    df = read_csv_inferred(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan
