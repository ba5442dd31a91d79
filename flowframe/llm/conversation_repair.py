"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by one integer per choice.

Each row of a conversation is kept, gets another role, or is deleted, and
empty turns may be inserted between rows.  The choices form a directed
acyclic graph over (row, state of the pattern).  A path's weight is a single
integer: its high digits hold the cost, its low digits the letters of the
path, one digit for each letter from the highest position on, ``WIDTH``
positions wide for the conversation and zero behind the last letter.  Letters
are numbered in ASCII order and zero is below them all, so the smaller of two
integers is the cheaper path and, among equally cheap ones, the one whose
letters come first.  The graph is solved from its end: an edge puts its
letter in front, which moves the digits behind it down one position, and its
cost on top; every choice is an ordinary minimum of integers.

What decides is narrow: for each row its place, its role's initial, whether
it is blank, cut off, and a digest that tells repeated rows.  A conversation's
narrow rows meet in one task, as its audit does, which holds a letter for each
of them; conversations of one shape are solved once.  Texts are not gathered:
a second pass streams each conversation's rows in order behind its audit and
hashes the repaired lines as they pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import arrow_schema, give_back, stage

#: Fixed values of the contract: what edits cost.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Letters of the audit in ASCII order; a letter's digit is its place, from 1 on.
LETTERS = "DIKR"
#: Bits of a digit.
DIGIT = 3
#: States of the pattern: nothing yet, after s, after u, after a.  Where a role's initial leads from each.
START, OPENED, ASKED, ANSWERED = range(4)
STEP = {"s": (OPENED, None, None, None), "u": (ASKED, ASKED, None, ASKED), "a": (None, None, ANSWERED, None)}
NAMES = {"u": "user", "a": "assistant"}

BLANK, DUPLICATE, CUT = "b", "d", "t"

REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> the rows that the contract's damage leaves, with ``copy`` (0, or 1 for a repeat)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return rows.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def plain_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The four columns under fixed names; a null role or text is one space."""
    return df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))


def digest(role: Column, text: Column) -> Column:
    """128 bits that two rows of a conversation share only when role and text are equal."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def with_order(rows: DataFrame) -> DataFrame:
    """Rows with ``same``: a conversation's order is (turn nulls first, role's initial, same, copy), total up to equal rows."""
    return rows.withColumn("same", digest(F.col("role"), F.col("text")))


def fault_of_text(text: Column) -> Column:
    """``b`` blank, ``t`` cut off, else empty."""
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(last == "", F.lit(BLANK)).when(last.rlike("[.!?]"), F.lit("")).otherwise(F.lit(CUT))


@lru_cache(maxsize=20_000)
def cheapest(shape: str) -> tuple[int, str]:
    """(cost, audit) of a conversation given as two characters a row: its role's initial and its fault (``.`` for none)."""
    rows = [(shape[i], shape[i + 1]) for i in range(0, len(shape), 2)]
    width = 2 * len(rows) + 3  # no cheapest path inserts twice in a row, but after a lone s at the end
    top = 1 << DIGIT * width
    low = top - 1
    front = {c: (k + 1) << DIGIT * (width - 1) for k, c in enumerate(LETTERS)}

    def edge(letter: str, cost: int, rest: int) -> int:
        return cost * top + (rest & ~low) + front[letter] + ((rest & low) >> DIGIT)

    def inserted(best: list[int | None]) -> list[int | None]:
        """After up to two insertions; a longer chain would only repeat a state at a cost."""
        for _ in range(2):
            after = list(best)
            for state in range(4):
                for name in "ua":
                    to = STEP[name][state]
                    if to is not None and best[to] is not None:
                        w = edge("I", INSERT, best[to])
                        after[state] = w if after[state] is None else min(after[state], w)
            best = after
        return best

    best = inserted([0, None, None, 0])  # the pattern may end before its first row and after an answer
    for initial, fault in reversed(rows):
        stays = TRUNCATED if fault == CUT else 0
        here: list[int | None] = []
        for state in range(4):
            choices = [edge("D", DELETE, best[state])] if best[state] is not None else []
            if fault not in (BLANK, DUPLICATE):
                to = STEP[initial][state] if initial in STEP else None
                if to is not None and best[to] is not None:
                    choices.append(edge("K", stays, best[to]))
                choices += [edge("R", RELABEL + stays, best[STEP[name][state]]) for name in "ua"
                            if STEP[name][state] is not None and best[STEP[name][state]] is not None]
            here.append(min(choices, default=None))
        best = inserted(here)
    cost, digits = divmod(best[START], top)
    octal = format(digits, "o").zfill(width)  # a digit is three bits
    return cost, octal.rstrip("0").translate({ord(str(k + 1)): c for k, c in enumerate(LETTERS)})


def audits(rows: DataFrame) -> DataFrame:
    """Ordered rows (``with_order``) -> REPORT, one row per conversation that has rows."""
    schema = arrow_schema(rows.sparkSession, REPORT)
    narrow = rows.select("conv_id", "turn", "copy", "same", F.substring("role", 1, 1).alias("initial"),
                         fault_of_text(F.col("text")).alias("fault"))

    def solve(group: pa.Table) -> pa.Table:
        cols = [group.column(c).to_pylist() for c in ("turn", "initial", "same", "copy", "fault")]
        in_order = sorted(zip(*cols), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:4]))
        seen, shape, counts = set(), [], {BLANK: 0, DUPLICATE: 0, CUT: 0}
        for _, initial, same, _, fault in in_order:
            if fault != BLANK and same in seen:
                fault = DUPLICATE
            seen.add(same)
            if fault:
                counts[fault] += 1
            shape.append((initial or " ")[0] + (fault or "."))
        turns = {r[0] for r in in_order if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(shape, shape[1:]))
        cost, audit = cheapest("".join(shape))
        return pa.Table.from_pylist([{
            "conv_id": group.column("conv_id")[0].as_py(), "gaps": gaps, "blank": counts[BLANK], "duplicate": counts[DUPLICATE],
            "truncated": counts[CUT], "illegal": illegal, "cost": cost, "audit": audit}], schema=schema)

    return narrow.groupBy("conv_id").applyInArrow(solve, REPORT)


def repaired_rows(rows: DataFrame, report: DataFrame, schema: str, fold) -> DataFrame:
    """Stream every conversation's ordered rows behind its audit through ``fold``.

    ``fold(conv_id, audit, lines)`` gets the repaired lines ``(role, text, edit)`` in order and yields rows of ``schema``.
    """
    out = arrow_schema(rows.sparkSession, schema)
    heads = report.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit(b"").alias("same"), F.lit(0).alias("copy"), F.lit("").alias("text"), "audit")
    body = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "same", "copy", "text", F.lit(None).cast("string").alias("audit"))
    lined = heads.unionByName(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", F.col("turn").asc_nulls_first(), F.substring("role", 1, 1), "same", "copy")

    def run(batches):
        stream = (r for b in batches for r in zip(*(b.column(c) for c in ("conv_id", "part", "role", "text", "audit"))))
        ahead: list = [next(stream, None)]

        def lines(audit: str) -> Iterator[tuple[str, str, str]]:
            at = START
            for letter in audit:
                if letter == "I":
                    name = "a" if at == ASKED else "u"
                    at = STEP[name][at]
                    yield NAMES[name], "", letter
                    continue
                row = ahead[0]
                ahead[0] = next(stream, None)
                if letter == "D":
                    continue
                role, text = row[2].as_py(), row[3].as_py()
                if letter == "R":
                    role = NAMES["a" if at == ASKED else "u"]
                at = STEP[role[:1]][at]
                yield role, text, letter

        held = []
        while ahead[0] is not None:
            head = ahead[0]
            ahead[0] = next(stream, None)
            fixed = lines(head[4].as_py())
            for row in fold(head[0].as_py(), head[4].as_py(), fixed):
                held.append(row)
                if len(held) >= 1024:
                    yield pa.RecordBatch.from_pylist(held, schema=out)
                    held = []
            for _ in fixed:
                pass  # rows that the fold did not ask for
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=out)
        give_back()

    return lined.mapInArrow(run, schema)


def hash_lines(conv_id: int | None, audit: str, lines: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
    h, first = hashlib.sha256(), True
    for role, text, _ in lines:
        h.update(("" if first else "\n").encode() + role.encode() + b":" + text.encode())
        first = False
    yield {"conv_id": conv_id, "repaired_sha256": h.hexdigest()}


def list_lines(conv_id: int | None, audit: str, lines: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
    for k, (role, text, edit) in enumerate(lines):
        yield {"conv_id": conv_id, "turn": k, "role": role, "text": text, "edit": edit}


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The repaired conversations: (conv_id, turn, role, text, edit), turns numbered from 0.

    Rows go by turn, nulls first, then the role's initial and a digest of role
    and text; wholly equal rows are interchangeable.  A null role or text is one space;
    a null conversation id is a conversation.  A row is blank without a word
    character, else a duplicate when its role and text came before, else
    truncated when its last one is none of ``.!?``.  Roles go by their first
    letter; one that is neither s, u nor a can only be given another role or
    deleted.  Other columns are not read; an empty table gives none.
    """
    rows = with_order(plain_turns(conversations, conv_col, turn_col, role_col, text_col).withColumn("copy", F.lit(0)))
    return repaired_rows(rows, audits(rows), "conv_id long, turn long, role string, text string, edit string", list_lines)


def repair_report(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """Per conversation: REPORT and the hash of its repaired lines; see ``repair`` for the cases.

    With ``damage`` the rows are first damaged by the contract's rule.  A
    conversation that is left without rows has zeros, an empty audit and the
    hash of the empty text.
    """
    rows = plain_turns(conversations, "conv_id", "turn", "role", "text")
    rows = with_order(damaged(rows) if damage else rows.withColumn("copy", F.lit(0)))
    report = stage(audits(rows), "audits")
    hashed = repaired_rows(rows, report, "conv_id long, repaired_sha256 string", hash_lines)
    known = report.withColumn("k", F.struct(F.lit(0), "conv_id")).join(
        hashed.select(F.struct(F.lit(0), "conv_id").alias("k"), "repaired_sha256"), "k")
    every = conversations.select(F.col("conv_id").cast("long").alias("c")).distinct().select("c", F.struct(F.lit(0), F.col("c").alias("conv_id")).alias("k"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(known.drop("conv_id"), "k", "left").select(
        F.col("c").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
