import itertools
import math
import random

import numpy as np
import pyarrow as pa

from grantledger.llm import quality as Q
from grantledger.llm.common import table
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(2)
    first = np.array([0, 1, 4, 6, 11])
    odds, links = rng.normal(size=11) * 2, rng.normal(size=(2, 2))
    forward, backward = Q.chain(first, odds, links)
    got = Q._sigmoid(forward + backward)
    for a, b in itertools.pairwise(first):
        mass, good = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            weight = math.exp(
                sum(odds[a + i] for i, y in enumerate(labels) if y) + sum(links[y][z] for y, z in itertools.pairwise(labels))
            )
            mass += weight
            good += weight * np.array(labels)
        assert np.allclose(got[a:b], good / mass)


def test_lines_of_a_batch_match_single_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choices(["a", "B!", "\n", " ", "9", "é", "| "], k=rng.randrange(30))) for _ in range(50)] + [None, ""]
    first, length, own = Q.batch_lines(pa.array(texts))
    assert own.shape[1] == Q.FEATURES
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        assert length[first[i] : first[i + 1]].tolist() == [len(line.encode()) for line in lines]
        _, _, alone = Q.batch_lines(pa.array([text or ""]))
        assert np.allclose(own[first[i] : first[i + 1]], alone)
        upper = own[first[i] : first[i + 1], Q.UPPER]
        assert np.allclose(upper, [sum("A" <= c <= "Z" for c in line) / max(len(line.encode()), 1) for line in lines])


def test_held_out_accuracy(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = Q.score(docs.select("doc_id", "text"), Q.train(docs, labels))
    rows = scored.where(Q.held_out()).join(labels, "doc_id").select("score", "quality").collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 for r in rows)
    right = sum((r.score >= Q.THRESHOLD) == bool(r.quality) for r in rows) / len(rows)
    assert right > 0.98


def test_odd_rows_and_no_labels(spark, docs_of):
    docs = docs_of(ODD, score="x", quality="q")
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels)
    rows = Q.score(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.quality == "q" for r in rows)
    assert Q.score(docs.where("false"), model).count() == 0
    untaught = Q.train(docs, labels.where("false"))
    assert {r.score for r in Q.score(docs, untaught).collect()} == {0.5}


def test_all_lines_of_a_document_are_learnt_from(spark, docs_of, monkeypatch):
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda first, *rest: seen.append(np.diff(first).tolist()) or fit(first, *rest, steps=5))
    docs = docs_of([(i, "\n".join([f"A good line {i}."] * 200 + ["$$ ## !!"] * 100 * i)) for i in range(12)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    known = [r.doc_id for r in labels.where(~Q.held_out()).orderBy(Q.seeded(Q.SEED, Q.F.col("doc_id")), "doc_id").collect()]
    sizes = [200 + 100 * i for i in known]
    Q.train(docs, labels)
    Q.train(docs, labels, lines=sum(sizes[:4]))
    Q.train(docs, labels, lines=1)
    assert [sorted(s) for s in seen] == [sorted(sizes), sorted(sizes[:4]), sizes[:1]]
