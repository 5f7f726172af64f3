from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import rows

from cartloom.llm import queries, repair
from cartloom.llm.repair import MOVES, ROLES, best, join_spans, parse, row_cell

SCHEMA = "conv_id long, turn long, role string, text string"


def every_edit(cells):
    """All (cost, audit, state) of a sequence of (initial, alive, truncated), up to two rows inserted at each place."""
    found = {(0, "", 0)}

    def inserted(states):
        out = set(states)
        for _ in range(2):
            out |= {(c + 5, a + "I", MOVES[s, i]) for c, a, s in out for i in "ua" if (s, i) in MOVES}
        return out

    found = inserted(found)
    for initial, alive, truncated in cells:
        after = {(c + 2, a + "D", s) for c, a, s in found}
        if alive:
            late = 5 * truncated
            after |= {(c + late, a + "K", MOVES[s, initial]) for c, a, s in found if (s, initial) in MOVES}
            after |= {(c + 1 + late, a + "R", MOVES[s, i]) for c, a, s in found for i in ROLES if (s, i) in MOVES}
        found = inserted(after)
    return min((c, a) for c, a, s in found if s in (0, 3))


def test_cells_equal_all_edits():
    kinds = [(i, alive, cut) for i in "suat" for alive in (True, False) for cut in ((False, True) if alive else (False,))]
    generator = random.Random(5)
    cases = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)]
    cases += [generator.choices(kinds, k=n) for n in (3, 4) for _ in range(60)]
    for case in cases:
        cost, audit, _, _ = best(parse([row_cell(*c) for c in case]))
        assert (cost, audit) == every_edit(case), case


def test_one_cut_of_a_span_is_as_good_as_all():
    """The full chart, with every cut of every span, has the same cells as the balanced halves."""
    generator = random.Random(6)
    for _ in range(40):
        spans = [row_cell(generator.choice("sua?"), generator.random() < 0.8, generator.random() < 0.4) for _ in range(generator.randint(1, 9))]
        n, chart = len(spans), {(i, i + 1): c for i, c in enumerate(spans)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                cuts = [join_spans(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
                chart[i, i + length] = {key: min(c[key] for c in cuts) for key in cuts[0]}
        assert chart[0, n] == parse(spans)


def by_hand(data):
    """Report and repaired rows of each conversation, row by row."""
    out = {}
    for conv in {r[0] for r in data}:
        mine = sorted(
            ((t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data if c == conv),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()),
        )
        seen, cells = set(), []
        n = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            cells.append((role[:1], fault not in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in mine if t is not None}
        n["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        state = {0: (0, "", [])}  # forward over the rows: (cost, audit, lines) by state

        def inserted(state):
            for _ in range(2):
                for (s, i), q in MOVES.items():
                    if s in state and i in ROLES:
                        c, a, m = state[s]
                        state[q] = min(state.get(q, (1 << 60,)), (c + 5, a + "I", [*m, ROLES[i] + ":"]))
            return state

        state = inserted(state)
        for (_, role, text), (initial, alive, cut) in zip(mine, cells):
            after = {s: (c + 2, a + "D", m) for s, (c, a, m) in state.items()}
            for (s, i), q in MOVES.items():
                if alive and s in state:
                    c, a, m = state[s]
                    if i == initial:
                        after[q] = min(after.get(q, (1 << 60,)), (c + 5 * cut, a + "K", [*m, f"{role}:{text}"]))
                    if i in ROLES:
                        after[q] = min(after.get(q, (1 << 60,)), (c + 1 + 5 * cut, a + "R", [*m, f"{ROLES[i]}:{text}"]))
            state = inserted(after)
        cost, audit, lines = min(state[s] for s in (0, 3) if s in state)
        out[conv] = {**n, "cost": cost, "audit": audit, "sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def found(df):
    pieces = repair.repair_conversations(df)
    digests = {r.conv_id: r.sha256 for r in repair.repaired_digests(pieces).collect()}
    report = rows(pieces.where("piece = 0").drop("piece", "n_pieces", "messages"))
    assert len(report) == len(digests)
    return {r["conv_id"]: {**{k: v for k, v in r.items() if k != "conv_id"}, "sha256": digests[r["conv_id"]]} for r in report}


def generated(seed, convs=25, most=12):
    generator = random.Random(seed)
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "Soé \U0001f600!", "end. x", "a\nb.\t "]
    data = []
    for conv in [None, *range(convs)]:
        for _ in range(generator.randint(1, most)):
            data.append((conv, generator.choice([None, *range(9)]), generator.choice(["system", "user", "assistant", "user", "tool", "", None]), generator.choice(texts)))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_row_by_row(spark, seed):
    data = generated(seed)
    assert found(spark.createDataFrame(data, SCHEMA).repartition(5)) == by_hand(data)


def test_a_long_conversation_is_cut_into_pieces(spark):
    """One conversation with most rows lies in many tasks and pieces; results stay those of one row after the other."""
    generator = random.Random(3)
    data = [(7, i // 2, generator.choice(["user", "assistant", "system"]), generator.choice([f"t{i}.", f"t{i}", "again.", " "])) for i in range(9000)]
    data += generated(9, convs=6)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    pieces = repair.repair_conversations(df)
    sizes = [r.n_pieces for r in pieces.where("conv_id = 7 and piece = 0").collect()]
    assert sizes[0] > 6
    got, want = found(df), by_hand(data)
    assert got == want
    audit = got[7]["audit"]
    assert sum(c != "I" for c in audit) == 9000
    # The edits of the audit cost what the report says and give the rows of the pieces.
    messages = [m for r in pieces.where("conv_id = 7").orderBy("piece").collect() for m in r.messages]
    assert re.fullmatch("(s?(ua)+)?", "".join(m.role[0] for m in messages))
    assert len(messages) == sum(c != "D" for c in audit)


def test_many_copies_of_a_row(spark):
    """Copies are counted, not moved; all but the first are deleted."""
    hot = spark.range(200_000, numPartitions=4).selectExpr("1L as conv_id", "0L as turn", "'user' as role", "'Hi.' as text")
    more = spark.createDataFrame([(1, 1, "assistant", "Yes."), (2, 0, "user", "Well")], SCHEMA)
    got = found(hot.unionByName(more))
    assert got[1]["duplicate"] == 199_999 and got[1]["illegal"] == 199_999 and got[1]["gaps"] == 0
    assert got[1]["cost"] == 2 * 199_999 and got[1]["audit"] == "K" + "D" * 199_999 + "K"
    assert got[2] == by_hand([(2, 0, "user", "Well")])[2]


def test_empty_tables_and_other_columns(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    wide = spark.createDataFrame([(5, 0, "user", "Hi.", 1, 2, 3)], SCHEMA + ", conv int, digest int, copies int")
    assert found(wide) == by_hand([(5, 0, "user", "Hi.")])
    renamed = spark.createDataFrame([(5, 0, "user", "Hi.")], "c long, t long, r string, x string")
    assert repair.repair_conversations(renamed, "c", "t", "r", "x").where("piece = 0").first().c == 5


def test_very_long_texts_stay_whole(spark):
    long = "word " * 600_000 + "end."
    data = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", long)]
    assert found(spark.createDataFrame(data, SCHEMA)) == by_hand(data)


def test_damage_follows_the_checksum(spark):
    data = [(None if i % 17 == 0 else i // 9, None if i % 23 == 0 else i % 9, "assistant", f"So {i}. Yes!") for i in range(600)]
    want = []
    for conv, turn, role, text in data:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        mark = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if mark == 4 else role, "" if mark == 1 else text.replace(".", "").replace("!", "") if mark == 2 else text)
        want += [row] * (mark != 0) + [row] * (mark == 3)
    got = [tuple(r) for r in repair.damage(spark.createDataFrame(data, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_returns_every_conversation(spark, tmp_path):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    data = [(dropped, 0, "user", "Gone."), (None, None, None, None), (5000, 3, "user", "Hi?")]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op13_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {dropped, None, 5000}
    assert got[dropped].audit == "" and got[dropped].cost == 0 and got[dropped].repaired_sha256 == hashlib.sha256(b"").hexdigest()
