import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from flowframe.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?\Z")
BEGINS = re.compile(r"(s?(ua)*u?)\Z")


def plain_cheapest(rows):
    """Uniform-cost search over (cost, audit): the first whole conversation that leaves the heap is the answer."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and PATTERN.match(roles):
            return cost, audit
        steps = [(3, "I", i, roles + r) for r in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            steps.append((4, "D", i + 1, roles))
            if fault not in "bd":
                late = 3 if fault == "t" else 0
                steps.append((late, "K", i + 1, roles + initial))
                steps += [(3 + late, "R", i + 1, roles + r) for r in "ua"]
        for w, letter, j, name in steps:
            if BEGINS.match(name):
                heapq.heappush(heap, (cost + w, audit + letter, j, name))


def plain_forward(rows):
    """The same by whole strings from the front, for conversations too long to search: state -> least (cost, audit)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                for r in after[state]:
                    if r != "s":
                        best[r] = min(best.get(r, (cost + 3, audit + "I")), (cost + 3, audit + "I"))
        return best

    best = inserted({"": (0, "")})
    for initial, fault in rows:
        step = {}
        for state, (cost, audit) in best.items():
            moves = [(state, 4, "D")]
            if fault not in "bd":
                late = 3 if fault == "t" else 0
                moves += [(r, late + 3 * (how == "R"), how) for r in after[state] for how in "KR"
                          if (how == "K" and r == initial) or (how == "R" and r != "s")]
            for to, w, letter in moves:
                step[to] = min(step.get(to, (cost + w, audit + letter)), (cost + w, audit + letter))
        best = inserted(step)
    return min(v for k, v in best.items() if k in ("", "a"))


def plain_report(rows):
    """Damage, faults and the repaired text of (conv_id, turn, role, text) rows, one conversation at a time."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = by_conv[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        md = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        kept += [(turn is not None, turn or 0, role[:1], md, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: r[:4])
        seen, shape = set(), []
        for *_, role, text in kept:
            mark = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "b" if not mark else "d" if (role, text) in seen else "t" if mark[-1] not in ".!?" else "."
            seen.add((role, text))
            shape.append(((role or " ")[0], fault))
        cost, audit = plain_forward(shape)
        lines, left, state = [], iter(kept), ""
        for letter in audit:
            *_, role, text = next(left) if letter != "I" else (None, None)
            if letter == "D":
                continue
            if letter in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text or ''}")
        turns = {r[1] for r in kept if r[0]}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(shape, shape[1:]))
        faults = [f for _, f in shape]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"),
                    faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def report_rows(df):
    return sorted((tuple(r) for r in cr.repair_report(df).collect()), key=str)


def test_cheapest_matches_uniform_cost_search():
    draw = random.Random(7)
    for _ in range(600):
        rows = [(draw.choice("suuaax"), draw.choice("....tbd")) for _ in range(draw.randrange(6))]
        assert cr.cheapest("".join(a + b for a, b in rows)) == plain_cheapest(rows) == plain_forward(rows), rows


@pytest.mark.parametrize("shape,cost,audit", [
    ("", 0, ""), ("s.", 4, "D"), ("s.u.a.", 0, "KKK"), ("u.u.a.", 3, "KIKK"), ("a.", 3, "IK")])
def test_small_shapes(shape, cost, audit):
    got = cr.cheapest(shape)
    assert got == plain_cheapest([(shape[i], shape[i + 1]) for i in range(0, len(shape), 2)])
    assert got == (cost, audit)


def test_long_conversation_is_solved():
    assert cr.cheapest("s." + "u.a." * 2000 + "u.") == (3, "K" * 4002 + "I")


def test_table_matches_plain_version(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert report_rows(conversations) == plain_report(rows)


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "user", "What"),
    (None, None, "user", "a."), (None, 3, None, "b."), (None, None, "assistant", None), (2, None, None, None),
    (3, 0, "system", "s."), (4, 0, "", "no role."), (5, 0, "tool", "x?"), (5, 1, "user", " \t"), (6, 2, "user", "w " * 60_000),
    (7, 0, "user", "\u2028"), (7, 1, "assistant", "end.\u0085"), (8, 0, "user", "a\nb.\n"), (9, 9, "assistant", "."),
] + [(20, i, "user" if i % 2 else "assistant", f"line {i}" + ".!?x"[i % 4]) for i in range(300)]


def test_odd_rows(spark):
    extra = "kind int, copy int, same string, part int, audit string, k long, c long"
    df = spark.createDataFrame([(*r, *(None,) * 7) for r in ODD], "conv_id long, turn long, role string, text string, " + extra)
    assert report_rows(df) == plain_report(ODD)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_report(df).collect() == [] and cr.repair(df).collect() == []


def test_repaired_rows_follow_the_pattern(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    by_conv = defaultdict(list)
    for r in cr.repair(conversations.where("turn <> 1")).collect():
        by_conv[r["conv_id"]].append((r["turn"], r["role"][0]))
    assert by_conv
    for turns in by_conv.values():
        turns.sort()
        assert [t for t, _ in turns] == list(range(len(turns))) and PATTERN.match("".join(x for _, x in turns))
