"""Conversation repair against a plain search over all edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from stellate.llm import turns

LEGAL = re.compile(r"(s?(ua)+)?")


def edits(roles, faults):
    """Least (cost, audit, lines) by plain dynamic programming over (row, initials so far reduced to a state)."""
    def state_of(word):
        return word[-1] if word else ""

    best = {(0, ""): (0, "", [])}
    n = len(roles)
    for at in range(n + 1):
        for _ in range(3):
            for (k, state), (cost, audit, out) in list(best.items()):
                if k == at:
                    role = "assistant" if state == "u" else "user"
                    new = (cost + 3, audit + "I", [*out, (role, None)])
                    if (at, role[0]) not in best or new[:2] < best[at, role[0]][:2]:
                        best[at, role[0]] = new
        if at == n:
            break
        for (k, state), (cost, audit, out) in list(best.items()):
            if k != at:
                continue
            moves = [("D", 4, None)]
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] == "truncated" else 0
                moves += [("K", more, roles[at])] + [("R", 3 + more, r) for r in ("user", "assistant")]
            for letter, price, role in moves:
                to = state
                if role is not None:
                    to = role[:1]
                    if not to or state + to not in ("s", "u", "su", "au", "ua"):
                        continue
                new = (cost + price, audit + letter, out if role is None else [*out, (role, at)])
                if (at + 1, to) not in best or new[:2] < best[at + 1, to][:2]:
                    best[at + 1, to] = new
    return min((best[n, s] for s in ("", "a") if (n, s) in best), key=lambda x: x[:2])


def test_repair_equals_search_over_all_codes_of_short_conversations():
    for n in range(4):
        for rows in itertools.product(range(16), repeat=n):
            roles = ["sua?"[k >> 2] for k in rows]
            assert turns.repair(bytes(rows)) == edits(roles, [turns.FAULTS[k & 3] for k in rows])[:2]


@pytest.mark.parametrize("block", [1, 3, 32])
def test_blocks_chain(monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    r = random.Random(block)
    for _ in range(200):
        rows = [r.randrange(16) if r.random() < 0.5 else 4 * r.randrange(3) for _ in range(r.randrange(70))]
        assert turns.repair(bytes(rows)) == edits(["sua?"[k >> 2] for k in rows], [turns.FAULTS[k & 3] for k in rows])[:2]


def expected(given):
    """The contract's columns, from the rows as a list."""
    conversations = {}
    for conv, turn, role, text in given:
        def s(x):
            return " " if x is None else str(x)

        lot = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        rows = conversations.setdefault(conv, [])
        text, role = s(text), s(role)
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        rows += [(turn, "user" if lot == 4 else role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    out = {}
    for conv, rows in conversations.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        seen, faults = set(), []
        for turn, role, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "ok")
            seen.add((role, text))
        known = [t for t, _, _ in rows if t is not None]
        roles = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, lines = edits([r for _, r, _ in rows], faults)
        whole = "\n".join(f"{role}:{'' if k is None else rows[k][2]}" for role, k in lines)
        assert LEGAL.fullmatch("".join(role[0] for role, _ in lines))
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest(),
        )
    return out


def check(df, given):
    rows = turns.repaired(turns.damaged(df)).collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    assert found == expected(given)


def test_damaged_conversations(spark):
    r = random.Random(8)
    texts = [None, "", " \t", "Yes.", "No", "Who? ", "é!\n", "long " * 3000 + ".", "a:b\nc."]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "assistant"]
    given = [(c, t, r.choice(roles), r.choice(texts)) for c in range(60) for t in range(r.randrange(9))]
    given += [(None, t, r.choice(roles), r.choice(texts)) for t in range(7)]
    given += [(999, t, "user" if t % 2 == 0 else "assistant", r.choice(texts)) for t in range(0, 400, 2)]  # a long one, with gaps
    given += [(1000, None, "user", "Null turn."), (1000, 3, "assistant", "Fine.")]
    given += [(1001, None, None, None)]
    df = spark.createDataFrame([(*row, "clash", 1) for row in given], "conv_id long, turn long, role string, text string, code string, copies int")
    check(df, given)
    check(df.repartition(5), given)


def test_repeated_rows_and_rows_of_one_turn(spark):
    given = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 2, "user", "Hi.")]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    check(df, given)


def test_empty_table_and_conversations_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert turns.repaired(turns.damaged(spark.createDataFrame([], schema))).collect() == []
    dropped = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = turns.repaired(turns.damaged(spark.createDataFrame(dropped, schema))).collect()
    assert len(rows) == len(dropped) > 0
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_whole_table_against_search(spark):
    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r)[1:] for r in turns.op12_turns(spark, folder).collect()}
    assert found == expected(given)


def test_rows_equal_throughout_a_hot_conversation_split(spark):
    from tests.support import final_plan

    rows = spark.range(100_000).selectExpr("if(id % 20 > 0, -1, id) AS conv_id", "id AS turn", "'user' AS role", "if(id % 20 > 0, 'Hi.', 'x' || id) AS text", "1 AS copies")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = turns.coded(turns._hashed(rows.repartition(16)))
        assert "skew=true" in final_plan(df)
        assert df.where("later").count() == 94_999
    finally:
        for key in settings:
            spark.conf.unset(key)
