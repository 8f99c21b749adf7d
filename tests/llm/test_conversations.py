import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from kerbside.llm import conversations, queries
from kerbside.llm.conversations import Costs

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gaps string, fault int, present_ string"


def blank(text):
    return not text.strip(" \t\n\x0b\x0c\r")


def slow_faults(rows):
    """(fault letter or '') of (turn, role, text) rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        if blank(text):
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            out.append("t")
        else:
            out.append("")
        seen.add((role, text))
    return out


def slow_repair(rows, costs=Costs()):
    """(cost, audit, repaired) by dynamic programming on whole audit texts, without pruning or ranks."""
    reach = {"": (0, "", [])}  # the shape of the roles so far: '', 's', 'u' or 'a' -> cost, audit, repaired rows

    def better(found, shape, way):
        if shape not in found or way[:2] < found[shape][:2]:
            found[shape] = way

    def inserted(found):
        for _ in range(2):
            for shape, (cost, audit, done) in list(found.items()):
                role = "assistant" if shape == "u" else "user"
                better(found, role[0], (cost + costs.insert, audit + "I", [*done, (role, "")]))
        return found

    for (_, role, text), fault in zip(rows, slow_faults(rows), strict=True):
        found = {}
        for shape, (cost, audit, done) in inserted(dict(reach)).items():
            better(found, shape, (cost + costs.delete, audit + "D", done))
            if fault in ("b", "d"):
                continue
            more = costs.truncated if fault == "t" else 0
            wanted = "a" if shape == "u" else "u"
            if role[:1] == wanted or (role[:1] == "s" and shape == ""):
                better(found, role[0], (cost + more, audit + "K", [*done, (role, text)]))
            new = "assistant" if shape == "u" else "user"
            better(found, wanted, (cost + more + costs.rerole, audit + "R", [*done, (new, text)]))
        reach = found
    ends = [way for shape, way in inserted(dict(reach)).items() if shape in ("", "a")]
    return min(ends, key=lambda way: way[:2])


def all_audits(rows):
    """The cheapest audit of a few rows, out of all there are."""
    faults, best = slow_faults(rows), None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * gap + edit for gap, edit in zip(gaps, edits)) + "I" * gaps[-1]
            shape, cost, at, legal = "", 0, 0, True
            for letter in audit:
                wanted = "a" if shape == "u" else "u"
                if letter == "I":
                    cost, shape = cost + 5, wanted
                    continue
                role, fault = rows[at][1], faults[at]
                at += 1
                if letter == "D":
                    cost += 2
                    continue
                cost += 5 if fault == "t" else 0
                if fault in ("b", "d"):
                    legal = False
                elif letter == "R":
                    cost, shape = cost + 1, wanted
                elif role[:1] == wanted or (role[:1] == "s" and shape == ""):
                    shape = role[0]
                else:
                    legal = False
            if legal and shape in ("", "a") and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def slow_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = slow_faults(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, repaired = slow_repair(rows)
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in repaired).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest), repaired


def draw_rows(seed, most=9):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "ux", ""]
    texts = ["Yes.", "No!", "cut", "", " \t", "Well?  ", "漢字", "so. on", "x.\n"]
    turns = sorted((draw.choice([None, *range(6)]) for _ in range(draw.randint(1, most))), key=lambda t: (t is not None, t or 0))
    return [(turn, draw.choice(roles[: draw.randint(2, 8)]), draw.choice(texts[: draw.randint(1, 9)])) for turn in turns]


def frame(spark, conversations_, parts=3):
    rows = [(key, *row, "x", 7, "y") for key, own in conversations_.items() for row in own]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


NAMES = (*conversations.REPORT, "audit", "repaired_sha256")


@pytest.mark.parametrize("seed", range(40))
def test_slow_repair_finds_the_cheapest_audit(seed):
    rows = draw_rows(seed, 3)
    assert slow_repair(rows)[:2] == all_audits(rows)


def test_reports_equal_slow_ones(spark):
    own = {key: draw_rows(key) for key in range(400)} | {None: draw_rows(-1)}
    found = conversations.repair_report(frame(spark, own)).collect()
    assert {row["conv_id"]: tuple(row[n] for n in NAMES) for row in found} == {k: slow_report(v)[0] for k, v in own.items()}
    assert len(found) == len(own)


def test_other_costs(spark):
    costs = Costs(rerole=4, delete=7, insert=2, truncated=1)
    own = {key: draw_rows(key + 1000) for key in range(200)}
    found = {r["conv_id"]: (r["cost"], r["audit"]) for r in conversations.repair_report(frame(spark, own), costs).collect()}
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert found == {key: slow_repair(order(rows), costs)[:2] for key, rows in own.items()}


def test_blocks_change_nothing_and_leave_no_files(spark, tmp_path, monkeypatch):
    """A conversation of 5,000 rows in blocks of 70, over many Arrow batches."""
    draw = random.Random(5)
    giant = [(n // 2, draw.choice(("user", "assistant", "system")), draw.choice(("Yes.", "cut", "", f"{n}."))) for n in range(5000)]
    own = {1: giant, 2: draw_rows(2), 3: [(n, "user", f"a{n}") for n in range(300)]}
    folder = tmp_path / "shared"
    monkeypatch.setattr(conversations, "scratch_dir", lambda spark, name: str(folder))
    found = conversations.repair_report(frame(spark, own), held_rows=70).collect()
    assert {row["conv_id"]: tuple(row[n] for n in NAMES) for row in found} == {k: slow_report(v)[0] for k, v in own.items()}
    assert folder.exists() and not list(folder.iterdir())
    few = conversations.repair_report(frame(spark, own), held_chars=100).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, found))


def test_repaired_turns_are_regular(spark):
    own = {key: draw_rows(key + 500) for key in range(100)}
    found = conversations.repaired_turns(frame(spark, own)).orderBy("conv_id", "turn").collect()
    for key, rows in own.items():
        mine = [(r["role"], r["text"]) for r in found if r["conv_id"] == key]
        assert mine == slow_report(rows)[1]
    again = conversations.repair_report(conversations.repaired_turns(frame(spark, own)).drop("edit"))
    assert again.agg(F.sum("illegal")).first()[0] == 0


def slow_damage(rows):
    import zlib

    out = {}
    for key, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        harm = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        own = out.setdefault(key, [])
        if harm == 1:
            text = ""
        elif harm == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif harm == 4:
            role = "user"
        own.extend([(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1))
    return out


def test_damaged_and_reported(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in queries.op11_conversations(spark, sf).collect()}
    assert found == {key: slow_report(own)[0] for key, own in slow_damage(rows).items()}


def test_odd_rows_and_whole_conversations_dropped(spark):
    """Nulls in every column, repeated rows, empty and very long texts, and conversations that damage empties."""
    rows = [(None, None, None, None), (None, 1, "user", None), (1, None, None, "a."), (1, 2, "user", "x" * 300_000 + ".")]
    rows += [(2, 1, "user", "same."), (2, 1, "user", "same."), (2, 1, "assistant", ""), (3, 2**60, "user", "late."), (3, 1, "", "?")]
    rows += [(key, 0, "user", "only.") for key in range(100, 200)]
    table = spark.createDataFrame([(*row, "x", 1, "z") for row in rows], SCHEMA)
    found = conversations.repair_report(conversations.damaged(table)).collect()
    expected = {key: slow_report(own)[0] for key, own in slow_damage(rows).items()}
    assert {row["conv_id"]: tuple(row[n] for n in NAMES) for row in found} == expected
    emptied = [row for row in found if not row["audit"] and row["conv_id"] and row["conv_id"] >= 100]
    assert emptied and all(tuple(row)[1:] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for row in emptied)


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(conversations.damaged(nothing)).collect() == []
    assert conversations.repaired_turns(nothing).collect() == []


def test_one_exchange(spark, plan):
    own = conversations.in_order(conversations.damaged(spark.createDataFrame([], SCHEMA)))
    assert plan(own).count("Exchange hashpartitioning") == 1
