"""Whole vectors, with null and empty ones."""

from leafwork.plans.queries import components


def test_every_component_and_every_parent(spark):
    rows = [(1, 7, [0.5, 1.0, 1.5, 2.0, 2.5, None]), (2, 7, []), (3, 8, None), (None, None, [4.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted(map(tuple, components(vectors).collect()), key=str)
    want = [(v, y, i + 1, x) for v, y, e in rows for i, x in enumerate(e or [])] + [(2, 7, None, None), (3, 8, None, None)]
    assert got == sorted(want, key=str)


def test_the_registered_query_gives_whole_vectors(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    want = spark.read.parquet(f"{sf}/embeddings.parquet").selectExpr("sum(greatest(1, coalesce(size(embedding), 1)))").first()[0]
    assert queries()["embedding_components"](spark, sf).count() == want
