"""Registered queries against their DuckDB twins, and the pipeline against its parts."""

from __future__ import annotations

import duckdb
import pytest

from delaylab.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    rows = sorted(tuple(map(str, r)) for r in got.select(*names).collect())
    assert rows == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    kept = pipeline.quality(spark, docs, SF)
    rules = pipeline.fertility.quality_rules(docs).where("kept")
    assert ids(kept) == ids(rules) and kept.columns == docs.columns
    single = pipeline.near_duplicates(spark, kept, SF).cache()
    classes = pipeline.simhash.simhash_dedup(kept)
    assert ids(single) == {r.component_id for r in classes.collect()}
    assert single.count() == len(ids(single)) and single.columns == docs.columns
    cut = pipeline.repeated_passages(spark, single, SF).cache()
    assert ids(cut) == ids(single) and cut.columns == docs.columns
    assert cut.where("n_chars <> length(text)").count() == 0
    clean = pipeline.decontamination(spark, cut, SF)
    dirty = pipeline.decontam.decontaminate(
        cut, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
    assert ids(clean) == ids(cut) - ids(dirty) and clean.columns == docs.columns
    mixed = pipeline.target_mix(spark, clean, SF)
    assert ids(mixed) <= ids(clean) and mixed.where("taken <= 0 or taken > 2 * size").count() == 0


def test_pipeline_on_awkward_rows(spark):
    import corpus_pipeline as pipeline

    from .helpers import awkward_rows, table

    docs = table(spark, awkward_rows(n=120))
    for rows in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES:
            rows = stage(spark, rows, SF)
            rows.collect()


def words(seed, n=80):
    import random

    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(n))


def test_near_duplicates_keep_one_of_every_group(spark):
    """Unlike texts that share an id are all kept; near copies without an id are one group."""
    import corpus_pipeline as pipeline

    from .helpers import table

    long = words(9, 3000)
    rows = [(1, words(1), "en", "a"), (1, words(2), "en", "a"), (2, words(3), "en", "a"),
            (1, words(3), "en", "a"), (None, long, "en", "a"), (None, long + " end", "en", "a"),
            (None, words(4), "en", "a"), (5, words(5), "en", "a"), (5, words(5), "en", "a"),
            (6, words(5), "en", "a"), (7, None, "en", "a"), (8, "", "en", "a")]
    kept = pipeline.near_duplicates(spark, table(spark, rows), SF).collect()
    found = sorted(((r.doc_id, r.text) for r in kept), key=str)
    with_long = [t for _, t in found if t in (long, long + " end")]
    assert len(with_long) == 1
    assert sorted((x for x in found if x[1] not in with_long), key=str) == sorted(
        [(1, words(1)), (1, words(2)), (1, words(3)), (None, words(4)), (5, words(5)),
         (7, None)], key=str)


def test_stages_write_tables_with_clashing_columns(spark, scratch):
    import corpus_pipeline as pipeline
    from pyspark.sql import functions as F

    from .helpers import awkward_rows, table

    docs = table(spark, awkward_rows(n=60)).withColumns({
        c: F.lit("mine") for c in ("_digest", "_row", "_verdict", "_own", "source_size", "target",
                                   "taken", "root", "fp", "node", "_new", "pattern")})
    names = docs.columns
    for i, (_, stage) in enumerate(pipeline.STAGES):
        path = f"{scratch}/clash{i}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < 4:
            assert docs.columns == names
            assert docs.where("_digest <> 'mine' OR root <> 'mine'").isEmpty()
    assert docs.select("size", "source_size", "target", "taken").dtypes == [
        ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    assert set(docs.columns) == set(names)


def test_quality_without_a_language_column(spark):
    import corpus_pipeline as pipeline

    from .helpers import awkward_rows, table

    docs = table(spark, awkward_rows(n=60)).drop("lang")
    kept = pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_entry_works_without_a_module_that_only_these_operators_need():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['xxhash'] = None\nimport __spark_entry__ as e\n"
            "q = e.queries(); print('N', len(q), 'op1_simhash' in q, 'flagship_daily_features' in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert " False True" in done.stdout, done.stderr
