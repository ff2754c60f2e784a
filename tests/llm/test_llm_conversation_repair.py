from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusflow.llm.conversation_repair import FINAL, auction, conversation_report, damaged, edits, repair_conversations, trace
from corpusflow.llm.queries import QUERIES
from corpusflow.ship import ship_package

ROWS = "conv_id long, turn long, role string, text string, conv string, key string, pos long, block long, code int, end string, tail int"
PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Least ``(cost, audit)`` and the repaired rows, by a plain search over strings of edits."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, said, out = heapq.heappop(heap)
        if i == len(rows) and PATTERN.fullmatch(said):
            return cost, audit, out
        state = (i, said[-1:])
        if state in seen:
            continue
        seen.add(state)
        for due in ("user", "assistant"):
            if re.fullmatch(r"s?(ua)*u?", said + due[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", i, said + due[0], (*out, (due, ""))))
                if i < len(rows) and rows[i][2] in (None, "truncated"):
                    heapq.heappush(heap, (cost + 2 + (rows[i][2] is not None), audit + "R", i + 1, said + due[0], (*out, (due, rows[i][1]))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, said, out))
            if fault in (None, "truncated") and re.fullmatch(r"s?(ua)*u?", said + role[:1]) and role[:1] in ("s", "u", "a"):
                heapq.heappush(heap, (cost + (fault is not None), audit + "K", i + 1, said + role[0], (*out, (role, text))))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_report(original, rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    out = []
    for conv in {r[0] for r in original}:
        own, seen, judged = sorted(by[conv]), set(), []
        for *_, role, text in own:
            shown = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            judged.append((role, text, fault))
            seen.add((role, text))
        turns = [t for known, t, *_ in own if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, repaired = cheapest(judged)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, *[sum(f == x for *_, f in judged) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return out


def conversations(seed, count, longest):
    rng = random.Random(seed)
    texts = ["Hello.", "Well", "What?", "", " \n", "End! ", "no end\t", "é漢。", "x" * 300 + "."]
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, rng.choice([*texts, f"Text {turn}.", None])))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Hm"), (999, None, None, None), (998, 0, "user", "A."), (998, 0, "user", "A.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", 1, 2, 3, "e", 4) for r in rows], ROWS)


@pytest.mark.parametrize(("block", "fan", "longest"), [(1024, 256, 9), (3, 3, 24)])
def test_reports_with_conversations_cut_into_blocks(spark, block, fan, longest):
    ship_package(spark)
    rows = conversations(block, 25, longest)
    summary, _ = repair_conversations(frame(spark, rows), block, fan)
    got = [tuple(r) for r in conversation_report(frame(spark, rows), summary).collect()]
    assert sorted(got, key=str) == sorted(plain_report(rows, rows), key=str)


def test_damage_and_what_nothing_is_left_of(spark):
    ship_package(spark)
    rows = conversations(7, 60, 6) + [(2_000 + i, i % 3, "user", "Only.") for i in range(60)]
    hurt = damaged(frame(spark, rows))
    assert sorted(map(tuple, hurt.collect()), key=str) == sorted(plain_damage(rows), key=str)
    summary, _ = repair_conversations(hurt)
    got = [tuple(r) for r in conversation_report(frame(spark, rows), summary).collect()]
    assert sorted(got, key=str) == sorted(plain_report(rows, plain_damage(rows)), key=str)
    assert sum(r[7] == "" and r[6] == 0 for r in got) >= 2


def test_repaired_rows_are_in_order(spark):
    ship_package(spark)
    rows = [(1, 0, "system", "S."), (1, 1, "user", "A?"), (1, 2, "user", "B?"), (1, 3, "assistant", "C.")]
    _, repaired = repair_conversations(frame(spark, rows))
    assert [(r.turn, r.role, r.text) for r in repaired.collect()] == [(0, "system", "S."), (1, "user", "A?"), (None, "assistant", ""), (2, "user", "B?"), (3, "assistant", "C.")]


def test_empty_table(spark):
    ship_package(spark)
    summary, repaired = repair_conversations(frame(spark, []))
    assert conversation_report(frame(spark, []), summary).count() == 0 and repaired.count() == 0


def test_prices_converge_to_the_cheapest_edits():
    rng = random.Random(3)
    for _ in range(3_000):
        codes = [rng.choice([0, 4, 4, 8, 8, 12]) + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 14))]
        prices = auction(codes, FINAL)
        rows = [("suat"[c // 4], str(i), (None, "blank", "duplicate", "truncated")[c % 4]) for i, c in enumerate(codes)]
        assert (prices[0][0], trace(codes, prices, 0, True)[1]) == cheapest(rows)[:2]
        # feasible everywhere: no price exceeds an arc and the price behind it
        for i, code in enumerate(codes):
            for x in range(4):
                assert all(prices[i][x] <= cost + (prices[i + 1] if passes else prices[i])[to] for _, cost, to, passes in edits(code, x))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_conversation_repair"](spark, folder).collect()]
    assert sorted(got, key=str) == sorted(plain_report(rows, plain_damage(rows)), key=str)
