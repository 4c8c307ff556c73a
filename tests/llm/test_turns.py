import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import turns
from tillroll.llm.queries import op12_turn_repair

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\v\f\r"


def _cheapest(rows):
    """(cost, audit) least by cost, then by the audit's letters: rows are (role, fault)."""
    after = {"": (0, ""), "a": (0, "")}
    step = {"": "u", "s": "u", "a": "u", "u": "a"}

    def inserted(at):
        for _ in range(4):
            for state, to in step.items():
                if to in at:
                    new = (at[to][0] + 3, "I" + at[to][1])
                    at[state] = min(at.get(state, new), new)
        return at

    after = inserted(after)
    for role, fault in reversed(rows):
        before = {}
        for state, to in step.items():
            found = []
            if state in after:
                found.append((after[state][0] + 4, "D" + after[state][1]))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if to in after:
                    found.append((after[to][0] + 3 + extra, "R" + after[to][1]))
                first = role[:1]
                if (first == to or (first == "s" and state == "")) and first in after:
                    found.append((after[first][0] + extra, "K" + after[first][1]))
            if found:
                before[state] = min(found)
        after = inserted(before)
    return after[""]


def _brute(rows):
    """The contract's row from (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("ok" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    dated = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = _cheapest([(r[1], f) for r, f in zip(rows, faults)])
    out, i = [], 0
    for edit in audit:
        role = "user" if not out or not out[-1].startswith("u") else "assistant"
        if edit == "I":
            out.append(role + ":")
            continue
        if edit == "K":
            out.append(f"{rows[i][1]}:{rows[i][2]}")
        elif edit == "R":
            out.append(f"{role}:{rows[i][2]}")
        i += 1
    assert i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return (max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def _damaged(table):
    """conv_id -> rows after damage; rows of a turn by role (and a hash, here never needed)."""
    found = {}
    for conv, turn, role, text in table:
        rows = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(key.encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        rows += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    for rows in found.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return found


def _tuples(df, key="conv_id"):
    return sorted(((r[key], r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
                   for r in df.collect()), key=str)


def _random(seed, n, lengths):
    draw = random.Random(seed)
    table = []
    for conv in range(n):
        turn, n_rows = draw.randint(-3, 3), draw.choice(lengths)
        undated = draw.randrange(40)  # at most one row: those of one turn are ordered by a hash
        for i in range(n_rows):
            table.append((conv, None if i == undated else turn,
                          draw.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None]),
                          draw.choice(["Hi.", "What?", "so", "", " \n", "and ", "No! ", None, "x.\t"]) if draw.random() < .5
                          else f"text {draw.random()}" + draw.choice([".", "", "?\n"])))
            turn += draw.choice([1, 1, 1, 2, 5])
    return table


TABLE = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_damaged_conversations(spark, partitions):
    """Conversations of up to 12 rows over ranges of every size, so that many lie in several."""
    table = _random(1, 150, range(0, 13)) + [(None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (None, None, None, None)]
    df = spark.createDataFrame(table, TABLE).select("*", F.lit("x").alias("conv"), F.lit(1).alias("part"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _tuples(turns.repair(turns.damage(df), present_col="present"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted(((c, *_brute(rows)) for c, rows in _damaged(table).items()), key=str)


def test_one_conversation_holds_most_rows(spark):
    """A conversation of 6,000 rows over many ranges, half of them one repeated row."""
    draw = random.Random(8)
    table = [(7, t, draw.choice(["user", "assistant", "system"]), draw.choice(["Same.", f"text {t}.", f"open {t}"]))
             for t in range(3000)] + [(7, 5000, "user", "Again.")] * 3000 + [(8, 1, "user", "Hi.")]
    df = spark.createDataFrame(table, TABLE)
    got = _tuples(turns.repair(df))
    rows = [r[1:] for r in table if r[0] == 7]
    assert got == sorted([(7, *_brute(rows)), (8, *_brute([(1, "user", "Hi.")]))], key=str)


def test_turns_are_those_of_the_audit(spark):
    table = _random(5, 40, range(1, 9))
    df = spark.createDataFrame(table, TABLE)
    audits = {r.conv_id: (r.audit, r.repaired_sha256) for r in turns.repair(df).collect()}
    edits = {}
    for r in sorted(turns.repaired_turns(df).collect(), key=lambda r: (r.part is None, r.part or 0, r.place)):
        edits.setdefault(r.conv_id, []).append(r)
    for conv, (audit, digest) in audits.items():
        own = edits.get(conv, [])
        assert "".join(r.edit for r in own) == audit
        lines = [f"{r.role}:{r.text}" for r in own if r.edit != "D"]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest


def test_empty_table_and_long_text(spark):
    assert turns.repair(spark.createDataFrame([], TABLE)).collect() == []
    long = "word " * 400_000
    rows = [(1, "user", long + "."), (2, "assistant", long)]
    df = spark.createDataFrame([(1, *r) for r in rows], TABLE)
    assert _tuples(turns.repair(df)) == [(1, *_brute(rows))]


def test_ranks_order_whole_audits():
    """After doubling, the ranks of all nodes are the order of their audits."""
    draw = np.random.default_rng(3)
    role, fault = draw.integers(0, 4, 60), draw.integers(0, 4, 60)
    roles, faults, bounds, _ = turns._with_ends(np.array([20, 0, 40]), fault, role)
    paths = turns.Paths(roles, faults, bounds, np.zeros((3, 4), np.int64))
    nodes = np.arange(4 * paths.n)
    path, letter, _, _ = paths.walk(nodes)
    audits = ["".join(turns.LETTERS[letter[path == i]]) for i in nodes]
    by_rank = sorted(nodes, key=lambda i: paths.rank[i])
    assert [audits[i] for i in by_rank] == sorted(audits)


def test_query_equals_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert _tuples(op12_turn_repair(spark, SF)) == sorted(((c, *_brute(r)) for c, r in _damaged(table).items()), key=str)
