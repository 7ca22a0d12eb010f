"""Registered corpus queries against their SQL, and what every operator does with odd tables."""

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tests.llm import frames
from tests.oracle_check import connect, differences
from tidewarden.llm import alignment, decontaminate, divergence, jaccard, langid, likelihood, linespread, mixing, pii, toxicity, winnowing
from tidewarden.llm.oracles import SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(registered.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(registered.queries()[name](spark, SF_DIR), con, SQL[name]) is None


LABELS = "doc_id long, quality int, toxic int"


def labels(spark):
    return spark.createDataFrame([(8, 1, 0), (9, 1, 1), (None, 0, 1), (5, None, None), (99, 1, 1)], LABELS)


def benchmark(spark):
    return spark.createDataFrame([(1, None), (None, "a b c"), (2, ""), (3, "a few words only here")], "item_id long, text string")


OPERATORS = {
    "pii": lambda s, d: pii.personal_data(d),
    "redacted": lambda s, d: pii.redacted(d),
    "likelihood": lambda s, d: likelihood.likelihood(d, rounds=1),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "without_toxic": lambda s, d: toxicity.without_toxic(d, labels(s)),
    "near_duplicates": lambda s, d: jaccard.near_duplicates(d),
    "one_of_each": lambda s, d: jaccard.one_of_each(d),
    "joined_overlaps": lambda s, d: decontaminate.overlaps(d.select("doc_id", "text"), benchmark(s), "hits", sent_bytes=-1),
    "contamination": lambda s, d: decontaminate.contamination(d, benchmark(s)),
    "without_contaminated": lambda s, d: decontaminate.without_contaminated(d, benchmark(s)),
    "lines": lambda s, d: linespread.without_spread_lines(d, sites=2),
    "mixing": lambda s, d: mixing.mixture(d),
    "language": lambda s, d: langid.identify(d, rounds=1),
    "winnowing": lambda s, d: winnowing.compared(d),
    "fingerprints": lambda s, d: winnowing.fingerprints(d),
    "alignment": lambda s, d: alignment.alignment(d),
    "aligned": lambda s, d: alignment.aligned(d),
    "divergence": lambda s, d: divergence.divergence(d),
}
FEWER = {"one_of_each", "without_contaminated", "without_toxic"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_keep_their_number(spark, name):
    docs = frames.odd_documents(spark)
    rows = OPERATORS[name](spark, docs).collect()
    assert len(rows) <= docs.count() or name == "divergence"
    if name not in FEWER | {"divergence"}:
        assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(r.doc_id) for r in docs.collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, frames.empty_documents(spark)).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_change_nothing(spark, name):
    docs = frames.odd_documents(spark)
    plain = OPERATORS[name](spark, docs)
    more = OPERATORS[name](spark, frames.clashing(docs))
    assert set(plain.columns) <= set(more.columns)
    assert frames.rows_of(more.select(*[f"`{c}`" for c in plain.columns])) == frames.rows_of(plain)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_columns_of_documents(spark, tmp_path, name):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frames.odd_documents(spark)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert {f.name: f.dataType for f in out.schema} == {f.name: f.dataType for f in docs.schema}
