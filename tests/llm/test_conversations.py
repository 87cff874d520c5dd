"""Repair of conversations against a search over all edits."""

import hashlib
import os
import random
import re
import zlib
from functools import cache

from ledgerlens.llm import conversations
from ledgerlens.llm.queries import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "conv_id long, turn long, role string, text string, kind string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """(cost, edits, repaired rows): the best of all suffixes, by recursion on rows and the last role's initial."""

    @cache
    def best(i, last, inserts):
        options = []

        def go(cost, edit, row, after, nxt, more=0):
            found = best(nxt, after, more)
            if found is not None:
                options.append((cost + found[0], edit + found[1], ((row,) if row else ()) + found[2]))

        if i == len(rows):
            if last in ("", "a"):
                return 0, "", ()
        else:
            role, text = rows[i]
            go(3, "D", None, last, i + 1)
            if faults[i] not in ("blank", "duplicate"):
                late = 1 if faults[i] == "truncated" else 0
                for edit, cost, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if new and (last + new[:1]) in ("s", "u", "su", "ua", "au"):
                        go(cost + late, edit, (new, text), new[:1], i + 1)
        if inserts < 4:
            for new in ("user", "assistant"):
                if (last + new[0]) in ("u", "su", "ua", "au"):
                    go(2, "I", (new, ""), new[0], i, inserts + 1)
        return min(options, default=None, key=lambda o: o[:2])

    return best(0, "", 0)


def expected(rows, damage=True):
    conversations_ = {}
    for conv in {r[0] for r in rows}:
        conversations_[conv] = []
    for r in plain_damage(rows) if damage else [(c, t, " " if o is None else o, " " if x is None else x) for c, t, o, x in rows]:
        conversations_[r[0]].append(r)
    out = []
    for conv, own in conversations_.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, seen = [], set()
        for _, _, role, text in own:
            body = BLANK.findall(text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, kept = cheapest(tuple(r[2:] for r in own), tuple(faults))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=str)


def repaired(df):
    return sorted((tuple(r) for r in df.select(*conversations.NAMES).collect()), key=str)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = repaired(queries()["op11_conversation_repair"](spark, FOLDER))
    assert result == expected(rows)
    assert len({r[7] for r in result}) > 10


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


ROLES = ["system", "user", "assistant", "tool", "user", "assistant", "", None, "umpire"]
TEXTS = ["Yes.", "No!", "What?", "cut off", "", "  \t", None, "Über alles.", "end. \n", "...", "é", " "]


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(250):
        for turn in range(rng.randrange(1, 9)):
            at = rng.choice([turn, turn, turn, turn + 3, None, 2])
            rows.append((conv if conv else None, at, rng.choice(ROLES), rng.choice(TEXTS)))
    for damage in (False, True):
        assert repaired(conversations.repair(table(spark, rows), damage)) == expected(rows, damage)


def test_ties_and_only_system(spark):
    rows = [(1, 0, "system", "Be kind."), (2, 0, "system", "Hi."), (2, 1, "assistant", "Yes."), (3, 0, "assistant", "a."), (3, 1, "user", "b.")]
    result = repaired(conversations.repair(table(spark, rows)))
    assert result == expected(rows, damage=False)
    assert {r[0]: r[7] for r in result}[1] == "D"


def test_conversation_without_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    result = repaired(conversations.repair(table(spark, [(conv, 0, "user", "Hello.")]), damage=True))
    assert result == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table_and_long_text(spark):
    assert conversations.repair(table(spark, []), damage=True).collect() == []
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y" * 2_000_000)]
    assert repaired(conversations.repair(table(spark, rows))) == expected(rows, damage=False)


def test_giant_conversation_spills(spark, monkeypatch):
    """One conversation over many Arrow batches, its pointers in the file; the same as in memory."""
    rng = random.Random(9)
    rows = [(1, turn, rng.choice(["user", "assistant", "system"]), f"text {turn % 700}{rng.choice(['.', '!', ''])}") for turn in range(30_000)]
    df = table(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        whole = repaired(conversations.repair(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pieces = []
    for spill in (4, 4096, 1 << 30):
        monkeypatch.setattr(conversations, "SPILL_BYTES", spill)
        one = conversations.Repair(1)
        seen = set()
        for _, turn, role, text in rows:
            kind = conversations.REPEAT if (role, text) in seen else conversations.SOUND if text[-1] in ".!" else conversations.CUT
            seen.add((role, text))
            one.row(turn, role, text, kind)
        pieces.append(one.result())
    assert pieces[0] == pieces[1] == pieces[2] == whole[0]
