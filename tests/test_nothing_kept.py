"""Queries on tables of which the filter keeps nothing, against their SQL.

Every vector has its opposite in the same class, so all class means are zero and no item
passes; larger tables of noise come close to that by themselves.
"""

import os

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from tests.test_catalog import FOLDER, rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("opposites")
    for name in os.listdir(FOLDER):
        os.symlink(f"{FOLDER}/{name}", path / name)
    (path / "embeddings.parquet").unlink()
    own = pq.read_table(f"{FOLDER}/embeddings.parquet")
    vectors = own["embedding"].combine_chunks()
    opposite = type(vectors).from_arrays(vectors.offsets, pc.negate(vectors.values), type=vectors.type)
    shifted = pc.add(own["vec_id"], pa.scalar(1000, own.schema.field("vec_id").type))
    other = own.set_column(own.schema.get_field_index("embedding"), own.schema.field("embedding"), opposite)
    other = other.set_column(own.schema.get_field_index("vec_id"), own.schema.field("vec_id"), shifted)
    pq.write_table(pa.concat_tables([own, other]), path / "embeddings.parquet")
    return str(path)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return con


def test_nothing_is_kept(spark, folder):
    assert contract.queries()["decision_counts"](spark, folder).first()["kept"] == 0


@pytest.mark.parametrize(
    "name",
    [
        "nearest_seeds",
        "category_weights",
        "eval_summary",
        "filter_metrics",
        "flagged_distribution",
        "review_queue",
        "run_counts",
        "label_accuracy",
        "priority_concentration",
        "top_review",
        "cluster_stats",
        "suggestions",
        "seed_votes",
        "confusion_dense",
        "category_ranking",
    ],
)
def test_query(spark, duck, folder, name):
    result = contract.queries()[name](spark, folder)
    theirs = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(result.columns)
    assert rows(result.columns, map(tuple, result.collect())) == rows(names, theirs.fetchall())
