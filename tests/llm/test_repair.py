"""Conversation repair against a plain dynamic program over whole audits."""

import hashlib
import random
import zlib

from shelfmark.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\v\f\r"


def damaged(rows):
    """conv_id -> rows (turn, role, text) after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        blank = " "
        key = f"{blank if conv is None else conv}:{blank if turn is None else turn}"
        role, text = blank if role is None else role, blank if text is None else text
        hit = zlib.crc32(key.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    digest = lambda t: hashlib.md5(t.encode()).digest()
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                 r[2][:64].encode(), digest(r[2])))
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        end = text.rstrip(WHITE)[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen
                     else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit, repaired turns), least over all edits, by whole audits per state."""
    after = {"": "s u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    # Whole audits are compared only where both have just taken the same turn, or at the very end.
    ways = {"": (0, "", [])}
    for (turn, role, text), fault in zip(rows, found):
        late = 3 if fault == "truncated" else 0
        new = {}
        for state, (cost, audit, turns) in all_inserts(ways, after, names):
            options = [(state, cost + 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                for to in after[state].split():
                    if role[:1] == to:
                        options.append((to, cost + late, "K", [(role, text)]))
                    if to != "s":
                        options.append((to, cost + 3 + late, "R", [(names[to], text)]))
            for to, price, letter, more in options:
                way = (price, audit + letter, turns + more)
                if to not in new or way[:2] < new[to][:2]:
                    new[to] = way
        ways = new
    return min((w for s, w in all_inserts(ways, after, names) if s in ("", "a")),
               key=lambda w: w[:2])


def all_inserts(ways, after, names):
    for state, way in ways.items():
        yield state, way
        cost, audit, turns = way
        for _ in range(3):
            state = "a" if state == "u" else "u"
            cost, audit, turns = cost + 3, audit + "I", turns + [(names[state], "")]
            yield state, (cost, audit, turns)


def expected(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        found = faults(kept)
        cost, audit, turns = cheapest(kept, found)
        known = [t for t, _, _ in kept if t is not None]
        pairs = zip(kept, kept[1:])
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


def run(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(
        f"{folder}/conversations.parquet")
    frame = queries.op11_conversation_repair(spark, folder)
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def random_rows(seed, convs, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "so then", "and. ", "", "  ", None, " ", "x" * 70 + "."]
    rows = []
    for conv in range(convs):
        for turn in range(draw.randint(1, longest)):
            rows.append((conv if conv else None, turn if draw.random() < 0.9 else None,
                         draw.choice(["user", "assistant", "system", "tool", "", None]),
                         draw.choice(texts) if draw.random() < .5 else f"t{draw.random()}."))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    return rows


def test_equals_whole_audits(spark, tmp_path):
    rows = random_rows(1, 60, 12)
    assert run(spark, tmp_path, rows) == expected(rows)


def test_long_conversation_over_many_ranges(spark, tmp_path):
    rows = random_rows(2, 3, 700) + random_rows(3, 30, 3)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, tmp_path, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_divided_chain_equals_greedy_search():
    draw = random.Random(4)
    for _ in range(400):
        kinds = "".join(draw.choice("suaoSUAOxxuaua") for _ in range(draw.randint(0, 9)))
        rows = [(0, {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[
            k.lower()], "t") for k in kinds]
        found = ["blank" if k == "x" else "truncated" if k.isupper() else "" for k in kinds]
        assert repair.audit(kinds) == cheapest(rows, found)[:2], kinds


def test_empty_table_and_dropped_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, tmp_path / "b", [(conv, 0, "user", "Hi.")]) == {
        conv: (0, 0, 0, 0, 0, 0, "", empty)}


def test_other_columns_do_not_matter(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 7, "x")],
                                 SCHEMA + ", cost bigint, audit string")
    assert repair.plans(rows).select("cost", "audit").collect() == [(3, "KI")]
