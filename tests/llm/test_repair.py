"""op12 against an uninformed search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest

from lociframe.llm import queries, repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, AUDIT string"


def plain(rows):
    """(cost, audit, turns) by uniform-cost search; rows: (initial, fault, role, text)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, ini, turns = heapq.heappop(heap)
        state = {"": 0, "s": 1, "u": 2, "a": 3}[ini]
        if i == len(rows) and state in (0, 3):
            return cost, audit, turns
        if (i, ini, audit) in done or len(audit) > 2 * len(rows) + 4:
            continue
        done.add((i, ini, audit))
        name = "assistant" if state == 2 else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", i, name[0], (*turns, name + ":")))
        if i < len(rows):
            own, fault, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, ini, turns))
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                if own and ini + own in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, own, (*turns, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, name[0], (*turns, f"{name}:{text}")))


def brute(rows):
    ids = {r[0] for r in rows}
    out = []
    for conv in ids:
        own = []
        for _, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            role = "user" if kind == 4 else role
            own += [(turn, role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in own:
            body = text.rstrip(WHITE)
            fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            marked.append((role[:1] if role[:1] in ("s", "u", "a") and role else "?", fault, role, text))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, repaired = plain(marked)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        counts = [sum(f == k for _, f, _, _ in marked) for k in (1, 2, 3)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Über"])
            text = rng.choice(["Yes.", "No!", "cut", "", " \t\x0b", None, "a?\n", "x. y", "É.", "Yes."])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, text, "own"))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_report(spark, tmp_path, seed):
    rows = corpus(seed)
    folder = str(tmp_path / "t")
    spark.createDataFrame(rows, SCHEMA).write.parquet(folder + "/conversations.parquet")
    got = queries.op12_conversation_repair(spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("seed", range(40))
def test_search(seed):
    rng = random.Random(seed)
    rows = [("sua?"[k], f, "sua?"[k], "t") for k, f in ((rng.choice([0, 1, 1, 2, 2, 3]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, 7)))]
    cost, audit, _ = plain(rows)
    assert repair.cheapest(bytes(f * 4 + "sua?".index(i) for i, f, _, _ in rows)) == (cost, audit)


def test_long_conversation_takes_time_in_proportion():
    rng = random.Random(3)
    codes = bytes(rng.choice([0, 1, 2, 3, 5, 9, 13, 14]) for _ in range(30_000)) + bytes([1])
    cost, audit = repair.cheapest(codes)
    spent, state, i = 0, 0, 0
    for letter in audit:
        used, state, price = next((u, q, c) for x, u, q, c in repair.edits(codes[i] if i < len(codes) else None, state) if x == letter)
        i, spent = i + used, spent + price
    assert i == len(codes) and state in (0, 3) and spent == cost >= repair.to_go(codes)[0][0]


def test_undamaged_rows_and_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "And?"), (2, 0, "system", "Be good."), (3, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in repair.report(df).collect()}
    assert (out[1].duplicate, out[1].audit, out[1].cost) == (1, "KDR", 7) and out[2].audit == "D" and (out[3].blank, out[3].audit) == (1, "D")
    turns = [(r.conv_id, r.place, r.edit, r.role, r.text) for r in repair.repaired(df).orderBy("conv_id", "place").collect()]
    assert turns == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "And?")]
    assert repair.report(df.limit(0)).count() == 0 and repair.repaired(df.limit(0)).count() == 0


def test_one_conversation_of_many_rows(spark):
    df = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Text ', id, '.') as text")
    (row,) = repair.report(df).collect()
    assert (row.cost, row.audit) == (0, "K" * 20_000)
