"""The training-data operators against brute force, round trips and awkward tables."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import (blocks, bpe, cotrain, mixing, nearvec, ngramjoin, postings, shards, shingles,
                           tokencount, toxicity)
from shelfmark.llm.components import components
from shelfmark.llm.queries import vocabulary

AWKWARD = ["", None, "a", "  a", "a   b", "foo\n  bar", "x\n \ny", "\x1ca b", "a\xa0 b", "日本語 é",
           "a" * 3000, "don't we'll", " \t\n", "the same", "the same", "b " * 2000]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    with open(vocabulary(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(k, t, None if k % 3 else "en", None if k % 5 else "s", None, "x")
            for k, t in enumerate(AWKWARD)] + [(None, "no id", "en", "s", 5, "y")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_encoding_equals_reference_and_round_trips(awkward, reference):
    path = vocabulary()
    rows = bpe.decode(bpe.encode(awkward, path), path).withColumn(
        "list", bpe.unpack_ids(F.col("ids"))).collect()
    assert len(rows) == len(AWKWARD) + 1
    for row in rows:
        ids = reference.encode_ordinary(row["text"] or "")
        assert row["list"] == ids
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
        assert hashlib.sha256(bytes(row["ids"])).digest() == hashlib.sha256(
            np.array(ids, "<u4").tobytes()).digest()


def test_scanned_matches_have_the_same_ids(reference):
    rng = random.Random(6)
    scan = bpe.Codec(bpe.read_ranks(vocabulary()), scanned=64)
    for _ in range(300):
        text = "".join(rng.choice("abeßé日z0 ") for _ in range(rng.randint(1, 90)))
        assert np.frombuffer(scan.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_texts_encoded_together_have_the_same_ids_and_merge_no_word_alone(reference, monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choices(" abcdefgh\n\t'ßéü日本語0123.,!s re", k=draw.randrange(60))) for _ in range(1500)]
    texts += [" ".join("".join(draw.choices("abcdetion", k=draw.randrange(1, 60))) for _ in range(5))
              for _ in range(300)]
    texts += ["", " ", "  a", " a  ", "a\n b ", "\nfoo\n bar\n"]
    for name in ("merge", "_scan"):
        monkeypatch.setattr(bpe.Codec, name, None)
    together = bpe.Codec(bpe.read_ranks(vocabulary())).together
    for part in (texts, texts[::-1], texts[:1], []):
        ids, n = together(part)
        ends = np.cumsum(n)
        found = [ids[end - size:end].tolist() for end, size in zip(ends, n, strict=True)]
        assert found == [reference.encode_ordinary(text) for text in part]


def test_section_counts_sum_to_the_whole(awkward, reference):
    rows = tokencount.section_counts(awkward, vocabulary()).collect()
    for k, text in enumerate(AWKWARD):
        own = [r for r in rows if r["doc_id"] == k]
        assert sum(r["n_tokens"] for r in own) == len(reference.encode_ordinary(text or ""))
        assert sorted(r["section"] for r in own if r["section"] >= 0) == list(
            range((text or "").count("\n") + 1))


def test_section_counts_equal_plain_loops_whatever_texts_share_a_join(spark, reference, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["\n", " ", "\n\n", "wörter", "日本", "abc def", "🔑"])
                     for _ in range(rng.randint(0, 30))) for _ in range(80)] + AWKWARD
    cuts = [sorted(rng.sample(range(40), 2 * rng.randint(0, 4))) for _ in texts]
    rows = [(k, t, [tuple(c[i:i + 2]) for i in range(0, len(c), 2)])
            for k, (t, c) in enumerate(zip(texts, cuts))]
    df = spark.createDataFrame(rows, "doc_id long, text string, cut array<struct<start:int,end:int>>")

    def plain(text, spans):
        size = [len(text[:c].encode()) for c in range(len(text) + 1)]
        counts, at = {}, 0
        for token in reference.encode_ordinary(text):
            end = at + len(reference.decode_single_token_bytes(token))
            shared = [min(end, size[b]) - max(at, size[a]) for a, b in spans]
            k = max(range(len(spans)), key=lambda i: (shared[i], -i), default=-1)
            k = k if k >= 0 and shared[k] > 0 else -1
            counts[k], at = counts.get(k, 0) + 1, end
        own = [(k, a, b, counts.get(k, 0)) for k, (a, b) in enumerate(spans)]
        return own + ([(-1, 0, 0, counts[-1])] if -1 in counts else [])
    calls, joined = [], tokencount.attribute
    codec, lengths = bpe.Codec(bpe.read_ranks(vocabulary())), None
    lengths = np.zeros(max(codec.tokens) + 1, np.int64)
    lengths[list(codec.tokens)] = [len(t) for t in codec.tokens.values()]
    monkeypatch.setattr(tokencount, "attribute", lambda *a: (calls.append(1), joined(*a))[1])
    tokencount._sections(codec, lengths, [t or "" for t in texts], None)
    assert len(calls) == 1  # one join for all texts
    for column in (None, "cut"):
        got = {}
        for r in tokencount.section_counts(df, vocabulary(), spans=column).collect():
            got.setdefault(r["doc_id"], []).append((r["section"], r["start"], r["end"], r["n_tokens"]))
        for k, text, cut in rows:
            text, spans = text or "", [(min(a, len(text or "")), min(b, len(text or ""))) for a, b in cut]
            if column is None:
                ends = [i for i, c in enumerate(text) if c == "\n"]
                spans = list(zip([0, *(e + 1 for e in ends)], [*ends, len(text)]))
            assert got.get(k, []) == plain(text, spans)


def test_crossing_token_goes_to_the_larger_part():
    found = tokencount.attribute(np.array([2, 3, 1]), np.array([0, 4]), np.array([3, 6]))
    assert found.tolist() == [0, 0, 1]
    assert tokencount.attribute(np.array([2]), np.array([0, 1]), np.array([1, 2])).tolist() == [0]


def test_shards_are_contiguous_and_even(spark):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randint(0, 400)) for k in range(500)] + [(500, None), (7, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shards.shard_by_bytes(df, shards.byte_size(), [F.col("doc_id")], 8).collect()
    assert len(got) == len(rows)
    sizes = [sum(len(r["text"] or "") + 1 for r in got if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 401
    for s in range(8):
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        later = [r["doc_id"] for r in got if r["shard"] > s]
        assert not later or max(r["doc_id"] for r in own) <= min(later)


def test_mix_reaches_targets(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 9)) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long")
    got = mixing.mix(df, F.col("words"), F.lit(1.0), [F.col("doc_id")]).collect()
    sizes, targets, taken = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["words"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    # The same filling, round by round.
    left, open_, want = 1.5 * sum(sizes.values()), dict(zip(["a", "b", "c", None], [5, 2, 1, 5])), {}
    while True:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w > 2 * sizes[s]]
        if not full:
            break
        for s in full:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
            del open_[s]
    want |= {s: level * w for s, w in open_.items()}
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 9


def test_ngram_join_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 8, 30, 120]))] for _ in range(40)]
    texts = []
    for _ in range(220):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, texts[0].upper()), (0, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = ngramjoin.join_documents(df, seldom=4).collect()

    def shingles(text):
        own = (text or "").lower().split()
        return {tuple(own[k:k + 4]) for k in range(max(1, len(own) - 3))} if own else set()
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    want = sorted((d, len(s), least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_signature_and_pass_the_parity_bound(percent):
    rng = np.random.default_rng(percent)
    repeated = np.full(1 << 20, 2 ** 64 - 1, np.uint64)
    for _ in range(1500):
        n = int(rng.integers(4, 400))
        a = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
        # As far apart as a link allows: some shingles are dropped, others are new.
        dropped = int(rng.integers(0, n * (100 - percent) // 100 + 1))
        new = max(0, 100 * (n - dropped) // percent - n)
        b = np.unique(np.concatenate([rng.permutation(a)[dropped:],
                                      rng.integers(0, 2 ** 64, new, np.uint64)]))
        shared = len(np.intersect1d(a, b))
        assert 100 * shared >= percent * (len(a) + len(b) - shared)
        either = np.union1d(a, b)
        index = ngramjoin._Index(either[rng.random(len(either)) < rng.random()], repeated, percent, 0.2)
        assert len(np.intersect1d(index(a)[0], index(b)[0]))
        odd = np.bitwise_count((ngramjoin._parity(a) ^ ngramjoin._parity(b)).view(np.uint64)).sum()
        assert odd <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_sketches_of_unequal_lengths_bound_the_difference(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 60, 64, 65, 1000, 5000):
        a = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
        b = np.union1d(a[n // 20:], rng.integers(0, 2 ** 64, n // 10, np.uint64))
        assert ngramjoin._odd(ngramjoin._sketch(a), ngramjoin._sketch(a)) == 0
        for x, y in ((a, b), (b, a), (a, a[n // 3:])):
            odd = ngramjoin._odd(ngramjoin._sketch(x), ngramjoin._sketch(y))
            assert odd <= len(np.setxor1d(x, y))
    far = np.union1d(a[2000:], rng.integers(0, 2 ** 64, 2000, np.uint64))
    assert ngramjoin._odd(ngramjoin._sketch(a), ngramjoin._sketch(far)) > 2500


def test_similar_sets_that_do_not_link_send_no_texts(spark, monkeypatch):
    """A large group around one text, each member too far from all others, is ruled out by sketches."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(1500)]
    texts = []
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(1500), 110):
            own[at] = f"x{k}_{at}"
        texts.append((k, " ".join(own)))
    sent, verified = [], ngramjoin._verified
    monkeypatch.setattr(ngramjoin, "_verified", lambda docs, owners, pairs, *rest: (
        sent.append(pairs.count()), verified(docs, owners, pairs, *rest))[1])
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = ngramjoin.join_documents(df, seldom=4).collect()
    assert sent == [0, 0] and sorted(r["component_id"] for r in got) == list(range(60))


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_as_words_allow_what_sketches_allow(spark, percent):
    rng = np.random.default_rng(percent)
    pairs = []
    for n in (4, 60, 64, 65, 500, 2000):
        a = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
        for drop in (0, n // 30, n // 4):
            b = np.union1d(a[drop:], rng.integers(0, 2 ** 64, n // 10, np.uint64))
            for x, y in ((a, b), (b, a)):
                odd = ngramjoin._odd(ngramjoin._sketch(x), ngramjoin._sketch(y))
                pairs.append((bytearray(ngramjoin._sketch(x)), bytearray(ngramjoin._sketch(y)), len(x), len(y),
                              odd * (100 + percent) <= (len(x) + len(y)) * (100 - percent)))
    df = spark.createDataFrame(pairs, "a binary, b binary, na long, nb long, allowed boolean").select(
        "na", "nb", "allowed", ngramjoin._words("a").alias("sa"), ngramjoin._words("b").alias("sb"))
    got = df.select("allowed", ngramjoin._few_words_odd(percent).alias("found")).collect()
    assert len({r["allowed"] for r in got}) == 2 and all(r["allowed"] == r["found"] for r in got)


def test_sketches_rule_large_sets_out_within_the_join(spark, monkeypatch):
    """Sets that fill the 256 parity bits: no row of the join of signatures is left to be counted."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(1500)]
    texts = []
    for k in range(30):
        own = list(base)
        for at in rng.sample(range(1500), 110):
            own[at] = f"x{k}_{at}"
        texts.append((k, " ".join(own)))
    ruled, asked = [], ngramjoin._few_odd
    monkeypatch.setattr(ngramjoin, "_few_odd", lambda pairs, *rest: (
        ruled.append(pairs.count()), asked(pairs, *rest))[1])
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = ngramjoin.join_documents(df, seldom=4).collect()
    assert sorted(r["component_id"] for r in got) == list(range(30))
    assert len(ruled) == 1  # only the pairs with heads come that far


def test_small_batches_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2_500))], ["k"])
    parts = list(ngramjoin._small(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert [p.num_rows for p in parts] == [1_000, 1_000, 500, 3]
    assert pa.Table.from_batches(parts)["k"].to_pylist() == [*range(2_500), 0, 1, 2]


def test_memos_are_kept_for_one_operator(spark):
    shingles.shingle_set("some words of a text here", 4)
    assert len(shingles._hashes)
    codec = bpe.codec_of(bpe.read_ranks(vocabulary()))
    assert not shingles._hashes and bpe.codec_of(bpe.read_ranks(vocabulary())) is codec
    shingles.shingle_set("some words of a text here", 4)
    assert not bpe._codecs and len(shingles._hashes)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    points = centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, 16)) * 0.25
    points[700:760] = points[3]
    rows = [(k, p.tolist()) for k, p in enumerate(points)]
    return points, rows + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16),
                           (5003, [1.0, None] + [0.0] * 14), (5020, [float("inf")] * 16)]


def test_vector_groups_equal_brute_force(spark, vectors):
    points, rows = vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in nearvec.groups(df, 0.9, shard_rows=500, block_rows=300).collect()}
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    links = unit @ unit.T >= 0.9
    assert [got[k]["n_links"] for k in range(1500)] == (links.sum(axis=1) - 1).tolist()
    label = np.arange(1500)
    while True:
        new = np.array([label[row].min() for row in links])
        if (new == label).all():
            break
        label = new
    assert [got[k]["component_id"] for k in range(1500)] == label.tolist()
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in (5000, 5001, 5002, 5003, 5020))


def test_nearest_recall_and_order(spark, vectors):
    points, rows = vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = postings.nearest(df, df.where("vec_id % 20 = 0"), lists=32).collect()
    found, hits = {}, 0
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert sorted(found) == list(range(0, 1500, 20))
    for query, rows_of in found.items():
        rows_of.sort()
        assert [x[0] for x in rows_of] == list(range(1, 21))
        assert [x[1:] for x in rows_of] == sorted(x[1:] for x in rows_of)
        scores = points @ points[query]
        scores[query] = -np.inf
        want = set(np.lexsort((np.arange(1500), -np.round(scores, 9)))[:20].tolist())
        hits += len(want & {x[2] for x in rows_of})
    assert hits >= 0.9 * 20 * len(found)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {k: 0 for k in range(31)} | {100 + k: 100 for k in range(40)}


def test_page_text():
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li>"
            "<a href=x>Home</a></ul></nav><div class='ad'>Buy now, only today and here!</div>"
            "<article><header><h1>A &amp; B</h1></header><p><b>First <i>li</i>ne<br>goes on<p>One."
            "</p><section class=comments><p>Nice article, I like it a lot!</p></section></article>"
            "<form><input> Sign up for all news</form><footer>&copy; someone, all rights</footer>")
    assert blocks.main_text(page) == "A & B\nFirst line goes on\nOne."
    assert blocks.main_text(None) == blocks.main_text("") == ""


def test_classifiers_learn_and_survive_awkward_tables(spark, awkward, empty):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    scored = cotrain.score(docs, cotrain.fit(docs, labels)).join(labels, "doc_id").toPandas()
    assert ((scored["score"] >= 0.5) == (scored["quality"] == 1)).mean() >= 0.95
    model = toxicity.fit(docs, labels)
    held = toxicity.score(docs, model).join(labels, "doc_id").where(
        ~toxicity.in_training_fold(F.col("doc_id"))).toPandas()
    assert ((held["score"] >= 0.7) == (held["toxic"] == 1)).mean() >= 0.9
    for table in (awkward, empty):
        assert toxicity.score(table, model).count() == table.count()
        assert all(0 <= r[0] <= 1 for r in toxicity.score(table, model).select("score").collect())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert cotrain.fit(awkward, none) is None
    assert toxicity.score(awkward, toxicity.fit(awkward, none)).count() == awkward.count()


def test_empty_tables(spark, empty):
    no_vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ngramjoin.join_documents(empty).count() == 0
    assert nearvec.groups(no_vectors).count() == 0
    assert postings.nearest(no_vectors, no_vectors).count() == 0
    assert shards.shard_by_bytes(empty, shards.byte_size(), [F.col("doc_id")]).count() == 0
    assert mixing.mix(empty, mixing.word_count(), mixing.plain_share(), [F.col("doc_id")]).count() == 0
    assert tokencount.section_counts(empty, vocabulary()).count() == 0


def test_token_sections_and_byte_pairs_are_read_from_tables(monkeypatch):
    """Neither tokens nor pairs of bytes are searched for one by one."""
    codec = bpe.Codec(bpe.read_ranks(vocabulary()))
    together, rng, searched = codec.together, np.random.default_rng(4), []
    texts = ["".join(rng.choice(list("abz é\n")) for _ in range(n)) for n in (0, 1, 50, 900)]
    assert (together.byte_pairs[:: 257] == together._made(together.byte_ids, together.byte_ids)).all()
    made = together._made
    monkeypatch.setattr(together, "_made", lambda a, b: searched.append(np.size(a)) or made(a, b))
    ids, n = together(texts)
    assert ids.tolist() == [i for t in texts for i in np.frombuffer(codec.encode(t), "<u4").tolist()]
    merges = sum(len(t.encode()) for t in texts) - len(ids)
    assert sum(searched) <= 2 * merges  # two pairs beside each merged one, none before
    lengths = rng.integers(1, 6, 400)
    cuts = np.unique(rng.integers(0, lengths.sum() + 1, 90))
    starts, ends = cuts[:-1:2], cuts[1::2][:len(cuts[:-1:2])]
    monkeypatch.setattr(np, "searchsorted", None)
    got = tokencount.attribute(lengths, starts, ends)
    stop = np.cumsum(lengths)
    for k, (a, b) in enumerate(zip(stop - lengths, stop)):
        shared = [min(b, e) - max(a, s) for s, e in zip(starts, ends)]
        best = int(np.argmax(shared))
        assert got[k] == (best if shared[best] > 0 else -1)
