"""Toxicity: held-out accuracy, pairs that a linear score cannot see, edge rows."""

import numpy as np
from edge_cases import tally

from brooklet.llm import toxicity
from brooklet.llm.queries import op2_toxicity


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = op2_toxicity(spark, sf_dir).filter("held_out").join(labels, "doc_id").toPandas()
    positive, negative = (held[held["toxic"] == y]["score"].to_numpy() for y in (1, 0))
    ranked = (positive[:, None] > negative).mean() + (positive[:, None] == negative).mean() / 2
    assert ranked > 0.85  # some labels here have nothing in the text to show for them
    assert ((held["predicted"] == 1) == (held["toxic"] == 1)).mean() > 0.93
    assert held["score"].between(0, 1).all()


def test_pairs_of_terms():
    """Label 1 only where an insult meets a group; each alone is harmless."""
    rng = np.random.default_rng(1)
    insult, group = rng.random(4000) < 0.4, rng.random(4000) < 0.4
    terms = [([0] if a else []) + ([1] if b else []) for a, b in zip(insult, group, strict=True)]
    label = (insult & group).astype(float)
    machine = toxicity.fit(np.array([11, 12]), terms, label)
    both, one, other = machine.score([[0, 1], [0], [1]])
    assert both > 0.9 and one < 0.1 and other < 0.1
    assert machine.factors[0] @ machine.factors[1] > 1


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 8)))
    found = machine.score([[0, 2, 5], []])
    y = 0.3 + machine.weights[[0, 2, 5]].sum()
    y += sum(machine.factors[i] @ machine.factors[j] for i, j in [(0, 2), (0, 5), (2, 5)])
    assert np.allclose(found, [1 / (1 + np.exp(-y)), 1 / (1 + np.exp(-0.3))])


def test_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), (14, None), (None, 1), (10, 0), (99, 1)], "doc_id bigint, toxic int"
    )
    machine = toxicity.train(edge, labels)
    scored = toxicity.score(edge, machine)
    assert scored.count() == edge.count()
    assert {r.doc_id for r in scored.collect()} == {r.doc_id for r in edge.collect()}
    assert scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    kept = toxicity.accepted(edge, machine)
    assert kept.columns == edge.columns
    assert kept.count() == scored.filter("predicted = 0").count()
    assert toxicity.score(empty, machine).count() == toxicity.accepted(empty, machine).count() == 0


def test_no_labels(spark, edge):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    machine = toxicity.train(edge, labels)
    assert {round(r.score, 6) for r in toxicity.score(edge, machine).collect()} == {0.5}


def test_labels_alone_decide_what_is_learned(spark, edge):
    """The same terms in and out of the training rows give the same score."""
    rows = [(i, "you utter pest" if i % 2 else "a fine day") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, toxic int")
    scored = tally(toxicity.score(docs, toxicity.train(docs, labels)))
    assert {r[0] % 2 for r in scored if r[2]} == {1}
    assert len({round(r[1], 9) for r in scored}) == 2


def paired_texts(n, rng, filler=30):
    """Texts of common words; label 1 where exactly both or none of two words are there: neither tells alone."""
    rows = []
    for i in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.integers(filler)}".translate(DIGITS) for _ in range(12)] + ["insult"] * a + ["group"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a == b)))
    return rows


DIGITS = str.maketrans("0123456789", "abcdefghij")


def test_pairs_are_learned_by_training(spark):
    rows = paired_texts(4000, np.random.default_rng(5))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 3000], "doc_id bigint, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert all(scores[i] >= 0.7 if y else scores[i] < 0.1 for i, _, y in rows[3000:])


def test_partners_tell_only_together():
    rng = np.random.default_rng(6)
    present = rng.random((3000, 40)) < 0.5
    label = (present[:, 3] & present[:, 7]) | (~present[:, 3] & ~present[:, 7])
    terms = np.nonzero(present)[1]
    starts = np.concatenate([[0], np.cumsum(present.sum(1))])
    assert set(toxicity.partners(terms, starts, label.astype(float)).tolist()) == {3, 7}
    assert not len(toxicity.partners(terms, starts, (rng.random(3000) < 0.3).astype(float)))
    assert not len(toxicity.partners(terms[:0], starts[:1], np.zeros(0)))
    assert not len(toxicity.partners(terms[:0], np.zeros(10, np.int64), np.ones(9)))


def test_the_query_against_its_parts(spark):
    """Every row, its remainder, the score of the machine fitted on the others, and the threshold."""
    import zlib

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").persist()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs.select("doc_id").collect()}
    used = [i for i, h in held.items() if not h]
    machine = toxicity.train(docs.filter(docs.doc_id.isin(used)), labels)
    scorer = toxicity.Scorer(machine)
    place = {int(b): i for i, b in enumerate(machine.selected)}
    found = {r.doc_id: r for r in op2_toxicity(spark, sf_dir).collect()}
    assert found.keys() == held.keys()
    for r in docs.collect():
        terms = {zlib.crc32(t.encode()) % toxicity.BUCKETS for t in toxicity.TERM.findall((r.text or "").lower())}
        at = sorted(place[b] for b in terms if b in place)
        assert at == scorer.positions(r.text or "")
        y = machine.bias + machine.weights[at].sum()
        y += sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(at) for j in at[:n])
        row = found[r.doc_id]
        assert row.held_out == held[r.doc_id] and abs(row.score - 1 / (1 + np.exp(-y))) < 1e-6
        assert row.predicted == int(row.score >= 0.7)
