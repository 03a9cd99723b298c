from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantledger.llm import quality
from grantledger.llm.common import table
from grantledger.session import settle
from tests.conftest import TESTDATA
from tests.llm import test_contamination, test_jaccard
from tests.llm.conftest import ODD
from tests.llm.test_mixing_sharding import shared_out

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_keep_the_columns(spark, steps):
    columns = table(spark, SF_DIR, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(steps)
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.columns == columns, name


def test_quality_keeps_what_scores_well(spark, steps):
    before, after = steps["quality"]
    model = quality.train(before, table(spark, SF_DIR, "labels"))
    good = quality.score(before, model).where(F.col("score") >= quality.THRESHOLD)
    assert rows(after) == rows(good)
    labels = table(spark, SF_DIR, "labels")
    judged = before.join(labels, "doc_id")
    bad = judged.where("quality = 0").select(*before.columns)
    assert after.join(bad, "doc_id", "left_semi").count() <= 0.1 * max(bad.count(), 10)
    fine = judged.where("quality = 1").select(*before.columns)
    assert after.join(fine, "doc_id", "left_semi").count() >= 0.95 * fine.count()


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    found = test_jaccard.plain([(r.doc_id, r.text) for r in before.collect()], words=5, percent=80)
    assert rows(after) == Counter(key for key, (n, component) in found.items() if not n or component == key[0])


def test_contaminated_documents_go(spark, steps):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    want = Counter((r.doc_id, r.text) for r in before.collect() if not test_contamination.plain(r.text, items)[1])
    assert rows(after) == want


def test_mixture_takes_its_targets(steps):
    before, after = steps["mixing"]
    size = lambda text: len((text or "").split())
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += size(r.text)
    for r in after.collect():
        taken[r.source] += size(r.text)
    order = sorted(sizes, key=lambda s: s.encode())
    want = shared_out(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    largest = max(size(r.text) for r in before.collect())
    assert all(abs(taken[s] - want[s]) <= largest / 2 + 1e-6 for s in sizes)
    assert max(rows(after).values()) <= 3 and not set(rows(after)) - set(rows(before))


def test_shards_hold_every_row(steps):
    before, after = steps["sharding"]
    assert rows(after) == rows(before)
    counts = Counter(r.shard for r in after.collect())
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(40))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, docs_of, name, stage):
    docs = docs_of(ODD)
    assert stage(spark, docs.where("false"), SF_DIR).count() == 0
    after = stage(spark, docs, SF_DIR)
    assert not rows(after) - Counter({key: 3 * n for key, n in rows(docs).items()})


def test_run_gives_the_rows_of_the_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(steps["sharding"][1])
