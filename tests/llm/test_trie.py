"""The conversation trie against nested dictionaries of whole sequences."""

import hashlib
import random
import re
import zlib

from shelfmark.llm import queries, trie
from shelfmark.scratch import settle

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def ordered(rows):
    """conv_id -> [(role, text)] in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn, role or "", text or ""))
    digest = lambda t: hashlib.md5(t.encode()).digest()
    return {conv: [(r, t) for _, r, t in sorted(kept, key=lambda r: (
        r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), digest(r[2])))]
        for conv, kept in out.items()}


def rebuilt(convs):
    out = {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = convs.get(base, [])[:h] + own[h:]
    return out


def expected(convs):
    members = {}
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children, below = {}, {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = (len(members[node]) - 1) * words(node) + sum(saved[k] for k in kids)
    out = []
    for node, convs_in in members.items():
        ends = sorted(c for c in convs_in if len(convs[c]) == len(node))
        out.append((min(convs_in), len(node), min(members[node[:-1]]) if node else None,
                    len(convs_in), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs, longest, choices=3):
    draw = random.Random(seed)
    texts = ["one", "two words", "", None, "a\tb\nc d", "é è"][:choices]
    rows = []
    for conv in range(convs):
        copied = [r for r in rows if r[0] == conv - 1]
        if copied and draw.random() < 0.4:        # an earlier conversation, perhaps cut or longer
            kept = copied[:draw.randint(1, len(copied))]
            rows += [(conv, *r[1:]) for r in kept]
            continue
        for turn in range(draw.randint(1, longest)):
            rows.append((conv, turn if turn else None, draw.choice(["user", "assistant", None]),
                         draw.choice(texts)))
    draw.shuffle(rows)
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def run(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    built = trie.build(trie.with_shared_beginnings(settle(trie.numbered(frame))), **sizes)
    return sorted((tuple(r) for r in built.select(*COLUMNS).collect()), key=repr)


def test_equals_dictionaries_in_one_shard(spark):
    rows = random_rows(1, 70, 6)
    assert run(spark, rows) == expected(rebuilt(ordered(rows)))


def test_equals_dictionaries_over_shards(spark):
    rows = random_rows(2, 200, 7) + [(-7, 0, "user", "x"), (-40, 1, "user", "y"),
                                     (10**12, 0, "user", "one")]
    assert run(spark, rows, target=40) == expected(rebuilt(ordered(rows)))


def test_equals_dictionaries_over_bands(spark):
    rows = random_rows(3, 50, 4, 2) + [
        (c, t, "user", f"w {t % 5}") for c in (60, 61, 80, 81, 99) for t in range(20 + c % 3)]
    assert run(spark, rows, target=40, band=4) == expected(rebuilt(ordered(rows)))


def test_nulls_and_repeated_rows(spark):
    rows = [(None, 0, "user", "lost"), (20, None, None, None), (20, None, None, None),
            (21, 5, "user", "long " * 50_000), (21, 5, "user", "long " * 50_000), (22, 1, "", "")]
    assert run(spark, rows) == expected(rebuilt(ordered(rows)))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_on_given_rows(spark, tmp_path):
    rows = random_rows(5, 45, 5)
    frame = spark.createDataFrame(
        [(*r, 9, "z") for r in rows], SCHEMA + ", depth bigint, parent string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_trie(spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rebuilt(ordered(rows)))
