"""The pipeline on the smallest tables, stage by stage, against brute force."""

from collections import Counter, defaultdict

import pytest
from test_text_operators import brute_dedup

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    return pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def staged(spark, pipeline, tmp_path_factory):
    """Input and output of every stage, written and read again."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_and_columns(staged):
    assert [name for name, _, _ in staged] == ["toxicity", "near_duplicates", "mixing", "packing"]
    for _, given, made in staged[:-1]:
        assert made.columns == given.columns and made.dtypes == given.dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, staged):
    _, given, made = staged[0]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    before, after = ({r["doc_id"] for r in d.collect()} for d in (given, made))
    assert after <= before and made.count() == len(after)
    gone = before - after
    assert gone and all(labels.get(i, 1) == 1 for i in gone)  # no document labelled clean is dropped


def test_one_document_of_each_group_stays(staged):
    _, given, made = staged[1]
    want = {i for i, _, _, kept in brute_dedup([(r["doc_id"], r["text"]) for r in given.collect()], 5) if kept}
    assert {r["doc_id"] for r in made.collect()} == want and made.count() == len(want) < given.count()


def test_mixing_keeps_every_document_and_evens_sources(staged):
    _, given, made = staged[2]
    count = lambda d: Counter(tuple(r) for r in d.collect())
    before, after = count(given), count(made)
    assert set(before) == set(after) and all(after[k] in (1, 2) for k in after) and made.count() > given.count()


def test_packing_holds_every_token_once(staged):
    _, given, made = staged[3]
    tokens = defaultdict(int)
    for r in made.collect():
        tokens[r["doc_id"]] += r["length"]
    from catalogspark.llm.bin_completion import vocabulary_path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    want = defaultdict(int)
    for r in given.collect():
        want[r["doc_id"]] += len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    assert tokens == want
    bins = defaultdict(int)
    for r in made.collect():
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 1024 and len(bins) <= -(-sum(bins.values()) // 1024) * 1.01 + 1


def test_run_is_the_stages(spark, pipeline, staged):
    got = pipeline.run(spark, SMALL)
    key = lambda d: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in d.collect())
    assert key(got) == key(staged[-1][2])


def test_entry_lists_the_queries():
    import __spark_entry__ as e

    names = list(e.queries())
    assert "pipeline" in names and [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert set(e.oracle_sql()) <= set(names)
