"""The pipeline's stages on repeated and null ids."""

import hashlib
import random
from collections import Counter

import corpus_pipeline as pipeline
from shelfmark.llm import ngramjoin

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SCHEMA)


def brute(rows):
    """Rows that stay, as a Counter of (doc_id, text)."""
    def shingles(text):
        own = (text or "").lower().split()
        return {tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for own, (k, t) in zip(label, rows):
        order = (k is None, k or 0, hashlib.sha256((t or "").encode()).hexdigest())
        least[own] = min(least.get(own, (order, k, t)), (order, k, t), key=lambda x: x[0])
    return Counter((k, t) for _, k, t in least.values())


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(6)]
    near = [t + " end" for t in base]
    rows = [(1, base[0]), (1, near[0]), (1, near[0]),       # copies that share the least id
            (2, base[1]), (5, near[1]), (5, base[2]),       # 5 heads its own group and copies 2
            (None, base[3]), (None, near[3]),               # a group of null ids alone
            (7, base[4]), (None, near[4]), (None, base[0]),  # copies with null ids
            (3, base[5]), (3, base[5]),                     # equal rows
            (8, ""), (8, ""), (None, None), (None, "  "), (9, None)]
    texts = base + near
    rows += [(rng.choice([None, *range(10, 16)]), rng.choice(texts[:5] + ["a b", "c"])) for _ in range(60)]
    got = Counter((r["doc_id"], r["text"]) for r in
                  pipeline.distinct(spark, table(spark, rows), "").collect())
    assert got == brute(rows)


def test_filters_keep_every_row_without_a_model(spark, monkeypatch):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (None, None), (2, "")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(pipeline, "_labels", lambda *_: none)
    docs = table(spark, rows)
    for stage in (pipeline.quality, pipeline.clean):
        got = Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect())
        assert got == Counter(rows)


def test_mix_and_encoding_take_rows_of_repeated_and_null_ids(spark):
    rows = [(k, f"word {k} and so on") for k in [1, 1, None, None, 2]] + [(1, "another text"), (None, None)]
    docs = table(spark, rows)
    coded = Counter(r["doc_id"] for r in pipeline.encoded(spark, docs, "").collect())
    assert coded == Counter(k for k, _ in rows)
    mixed = Counter((r["doc_id"], r["text"]) for r in pipeline.mixture(spark, docs, "").collect())
    assert set(mixed) <= set(rows)
    assert all(n <= 2 * Counter(rows)[k] for k, n in mixed.items())


def test_texts_are_shuffled_once_a_stage_and_postings_once(spark, monkeypatch):
    docs = table(spark, [(k, f"word {k} and so on and so on") for k in range(9)])
    given = []
    mix = pipeline.mixing.mix
    monkeypatch.setattr(pipeline.mixing, "mix", lambda df, *a, **k: given.append(df.columns) or mix(df, *a, **k))
    assert set(pipeline.mixture(spark, docs, "").columns) == set(pipeline.COLUMNS)
    assert given and "text" not in given[0]
    plan = pipeline.distinct(spark, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and not any("Aggregate" in line and "sha2" in line for line in plan.splitlines())

    rows = spark.createDataFrame([(k, 5, [1, k % 3 + 2], [0, -1]) for k in range(9)],
                                 "node long, n long, sigs array<long>, places array<int>")
    live = ngramjoin._live(rows.unionAll(rows))
    assert sorted(tuple(r) for r in live.collect()) == sorted(
        (s, p, k, 5) for k in range(9) for s, p in ((1, 0), (k % 3 + 2, -1)))
    assert ngramjoin._live(rows.where("node = 0").unionAll(rows.where("node = 0"))).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = ngramjoin._live(rows)
        live.collect()
        done = live._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        exchanges = [line for line in done.splitlines() if "Exchange" in line]
        assert len([line for line in exchanges if "ReusedExchange" not in line]) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
