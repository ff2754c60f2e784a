"""Conversations brought to the order system?, (user, assistant)* by the cheapest edits.

Rows of a conversation are taken by turn, nulls first; rows of one turn by a hash of role and text.
A row is blank, a duplicate of an earlier one, or truncated; the first that holds counts.

The edits are a shortest path.  Its nodes are pairs of a row and a state (nothing yet, system,
user, assistant spoken last), its arcs the edits: keep (0), rerole to the role that is due
(2), delete (3), insert an empty row of the role that is due (2); truncated rows add 1 unless
deleted, blank and repeated ones must go.

Prices are found by auction.  A path grows from its origin: while the price of its last node is
below the cheapest arc plus the price behind it, the price rises to that and the path
contracts by the node; otherwise the arc is tight and the path extends along it, until it meets a
node whose price has converged.  Then every arc of the path is tight, so all its prices have.
Origins are taken from the last row to the first.  Prices depend on the row's kind and on the
differences between the prices behind it alone; settled cases are kept and looked up.

From converged prices the audit is read off: at each node the tight arc with the least letter
(D, I, K, R).  A letter determines the state that follows, so this is the least audit of all
cheapest ones.

Long conversations are cut into blocks of ``BLOCK`` rows.  The auction of a block prices the
way from each of its four entries to each exit; such tables compose, ``FAN`` at a time, up to
the conversation and back, which gives every block the prices behind it.  Exits by entry
compose the same way and give every block its entry.  No task holds more than a block of rows
or ``FAN`` tables.  Only the digest of a repaired conversation passes all its text through one
task, row by row, as a digest is a chain; the audit is one string by its nature.

Nulls in ``role`` and ``text`` count as one space; null turns come first and take no part in
``gaps``; rows with a null ``conv_id`` are one conversation.  Empty texts are blank.  Repeated
rows are duplicates, ties between equal rows make no difference.  Very long texts are hashed
and passed on, never split.  An empty table gives no rows; columns beside the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.joins import join_null_safe
from corpusflow.llm.common import SPACES, sent_whole
from corpusflow.operators.scan import number_rows
from corpusflow.scratch import stored

BLOCK = 1024
FAN = 256

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after the role that is due.
DUE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Kinds of roles by initial, and of faults by precedence.
INITIALS, OTHER = "sua", 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
KEEPS = {0: {NOTHING: SYSTEM}, 1: {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, OTHER: {}}

#: Prices behind the last row: the conversation may end with nothing or an assistant.
FINAL = (0, 4, 2, 0)

Prices = tuple[int | None, ...]


def edits(code: int, state: int) -> list[tuple[str, int, int, bool]]:
    """``(letter, cost, state after, passes the row)`` by letter; ``code`` is initial * 4 + fault."""
    initial, fault = divmod(code, 4)
    out = [("D", 3, state, True), ("I", 2, DUE[state], False)]
    if fault in (SOUND, TRUNCATED):
        extra = int(fault == TRUNCATED)
        if state in KEEPS[initial]:
            out.append(("K", extra, KEEPS[initial][state], True))
        out.append(("R", 2 + extra, DUE[state], True))
    return out


@lru_cache(maxsize=100_000)
def _settled(code: int, behind: Prices) -> Prices:
    """Converged prices of a row's four nodes, given those behind the row; None: no way."""
    arcs = [[(cost, to, passes) for _, cost, to, passes in edits(code, x)] for x in range(4)]
    open_ = [any(passes and behind[to] is not None for _, to, passes in arcs[x]) for x in range(4)]
    for _ in range(4):
        open_ = [open_[x] or any(not passes and open_[to] for _, to, passes in arcs[x]) for x in range(4)]
    arcs = [[(c, to, passes) for c, to, passes in arcs[x] if (behind[to] is not None if passes else open_[to])] for x in range(4)]
    # below every way on, and so a feasible start
    prices = [min((p for p in behind if p is not None), default=0)] * 4
    converged = [False] * 4
    for origin in (x for x in range(4) if open_[x]):
        path = [origin]
        while not converged[path[-1]]:
            x = path[-1]
            best, to, passes = min((c + (behind[to] if passes else prices[to]), to, passes) for c, to, passes in arcs[x])
            if best > prices[x]:
                prices[x] = best
                if len(path) > 1:
                    path.pop()
            elif passes:
                break
            else:
                path.append(to)
        for x in path:
            converged[x] = True
    return tuple(prices[x] if open_[x] else None for x in range(4))


def auction(codes: list[int], end: Prices) -> list[Prices]:
    """Prices before every row and behind the last, the latter as given."""
    out = [tuple(end)]
    for code in reversed(codes):
        behind = out[-1]
        low = min((p for p in behind if p is not None), default=0)
        found = _settled(code, tuple(None if p is None else p - low for p in behind))
        out.append(tuple(None if p is None else p + low for p in found))
    return out[::-1]


def trace(codes: list[int], prices: list[Prices], state: int, last: bool) -> tuple[int, str, list[tuple[str, str]], str]:
    """Exit state, audit, ``(roles inserted before, role or K or D)`` of every row, and roles inserted at the end."""
    audit, out = [], []
    for i, code in enumerate(codes):
        lead = ""
        while True:
            letter, to, passes = next(
                (letter, to, passes) for letter, cost, to, passes in edits(code, state)
                if (p := prices[i + 1][to] if passes else prices[i][to]) is not None and cost + p == prices[i][state]
            )
            audit.append(letter)
            state = to
            if passes:
                break
            lead += INITIALS[to - 1]
        out.append((lead, INITIALS[state - 1] if letter == "R" else letter))
    tail = ""
    while last and prices[-1][state]:
        state = DUE[state]
        audit.append("I")
        tail += INITIALS[state - 1]
    return state, "".join(audit), out, tail


def passage(codes: list[int]) -> list[int | None]:
    """Prices from each entry to each exit of a block, entry by entry."""
    columns = [auction(codes, tuple(0 if y == exit_ else None for y in range(4)))[0] for exit_ in range(4)]
    return [columns[exit_][x] for x in range(4) for exit_ in range(4)]


def _behind(table: list[int | None], end: Prices) -> Prices:
    """Prices before a block, from those behind it."""
    ways = [[table[4 * x + y] + end[y] for y in range(4) if table[4 * x + y] is not None and end[y] is not None] for x in range(4)]
    return tuple(min(w, default=None) for w in ways)


def _joined_tables(tables: list[list[int | None]]) -> list[int | None]:
    columns = []
    for exit_ in range(4):
        end: Prices = tuple(0 if y == exit_ else None for y in range(4))
        for table in reversed(tables):
            end = _behind(table, end)
        columns.append(end)
    return [columns[exit_][x] for x in range(4) for exit_ in range(4)]


def _ends(tables: list[list[int | None]], end: list[int]) -> list[list[int | None]]:
    """Prices behind every one of consecutive blocks."""
    out = [list(end)]
    for table in reversed(tables[1:]):
        out.append(list(_behind(table, tuple(out[-1]))))
    return out[::-1]


def _joined_exits(exits: list[list[int]]) -> list[int]:
    out = list(range(4))
    for table in exits:
        out = [table[x] for x in out]
    return out


def _entries(exits: list[list[int]], entry: list[int]) -> list[list[int]]:
    """Entry state of every one of consecutive blocks, as a list of one."""
    out = [list(entry)]
    for table in exits[:-1]:
        out.append([table[out[-1][0]]])
    return out


def _composed(blocks: DataFrame, joined: Callable, given: Callable, top: list[int], fan: int) -> DataFrame:
    """``conv, block, got`` from ``blocks(conv, block, value)``: what each block is given by those around it.

    Values are joined ``fan`` at a time up to one a conversation, which is given ``top``;
    ``given`` deals that out to the parts again.
    """
    numbers = T.ArrayType(T.LongType())
    join, deal = F.udf(joined, numbers), F.udf(given, T.ArrayType(numbers))
    levels, now = [], blocks
    while now.where("block > 0").head(1):
        parts = F.sort_array(F.collect_list(F.struct("block", "value")))
        groups = now.groupBy("conv", F.expr(f"block div {fan}").alias("above")).agg(parts.alias("parts"))
        groups = stored(groups.withColumn("value", join(F.col("parts.value"))), "levels")
        levels.append(groups)
        now = groups.select("conv", F.col("above").alias("block"), "value")
    got = now.select("conv", "block", F.array(*[F.lit(x).cast("long") for x in top]).alias("got"))
    for groups in reversed(levels):
        met = join_null_safe(groups.drop("value"), got.withColumnRenamed("block", "above"), ["conv", "above"])
        pairs = F.explode(F.arrays_zip(F.col("parts.block").alias("block"), deal(F.col("parts.value"), F.col("got")).alias("got"))).alias("p")
        got = stored(met.select("conv", pairs).select("conv", "p.block", "p.got"), "given")
    return got


def plain(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, key``: nulls of role and text replaced, and a hash of both."""
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    out = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return out.withColumn("key", F.unhex(F.sha2(same.cast("binary"), 256)))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """``conv, block, rows``: for every block its rows ``(pos, code, turn, key)`` in order."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(*".!?"), SOUND).otherwise(TRUNCATED)
    initial = F.coalesce(*[F.when(F.startswith("role", F.lit(x)), i) for i, x in enumerate(INITIALS)], F.lit(OTHER))
    narrow = stored(rows.select("conv", "turn", "key", initial.alias("initial"), fault.alias("fault"), F.monotonically_increasing_id().alias("rid")), "rows")
    numbered = stored(number_rows(narrow, ["conv"], ["turn", "key", "rid"], "pos").drop("rid"), "numbered")
    firsts = numbered.groupBy("conv", "key").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("first"))
    judged = join_null_safe(numbered, firsts, ["conv", "pos"], "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    row = F.struct("pos", (F.col("initial") * 4 + fault).alias("code"), "turn", "key")
    return judged.groupBy("conv", F.expr(f"pos div {block}").alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def _per_block(blocks: DataFrame, column: str, work: Callable) -> DataFrame:
    """``blocks`` with a list of whole numbers made from the codes of its rows and the column ``end``."""
    return blocks.withColumn(column, F.udf(work, T.ArrayType(T.LongType()))(F.col("rows.code"), "end"))


def solve(rows: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """For every block of ``plain`` rows: counts, cost, audit and the edits of its rows."""
    blocks = stored(_blocks(rows, block), "blocks")
    nothing = F.lit(None).cast("array<bigint>")
    long = stored(blocks.where("block > 0").select("conv", F.lit(True).alias("long")).distinct(), "long")
    marked = join_null_safe(blocks, sent_whole(long), ["conv"], "left")
    whole = marked.where("long IS NULL").select("conv", "block", "rows", F.array(*map(F.lit, FINAL)).cast("array<bigint>").alias("end"), F.lit(0).alias("entry"), F.lit(-1).alias("before"), F.lit(True).alias("last"))
    if long.head(1):
        parts = stored(marked.where("long"), "parts")
        tables = _per_block(parts.withColumn("end", nothing), "value", lambda codes, _: passage(codes))
        ends = _composed(stored(tables.select("conv", "block", "value"), "tables"), _joined_tables, _ends, list(FINAL), fan)
        priced = stored(join_null_safe(parts, ends.withColumnRenamed("got", "end"), ["conv", "block"]), "priced")
        exits = _per_block(priced, "value", lambda codes, end: [trace(codes, auction(codes, tuple(end)), x, False)[0] for x in range(4)])
        entries = _composed(stored(exits.select("conv", "block", "value"), "exits"), _joined_exits, _entries, [NOTHING], fan)
        placed = join_null_safe(priced, entries.select("conv", "block", F.col("got")[0].alias("entry")), ["conv", "block"])
        neighbours = lambda step, name, value: parts.select("conv", (F.col("block") + step).alias("block"), value.alias(name))
        placed = join_null_safe(placed, neighbours(1, "before", F.element_at("rows", -1)["code"]), ["conv", "block"], "left")
        placed = join_null_safe(placed, neighbours(-1, "more", F.lit(True)), ["conv", "block"], "left")
        placed = placed.select("conv", "block", "rows", "end", F.col("entry").cast("int"), F.coalesce("before", F.lit(-1)).alias("before"), F.col("more").isNull().alias("last"))
        whole = whole.unionByName(placed)
    conv = rows.schema["conv"].dataType.simpleString()
    edit = "struct<pos:bigint,turn:bigint,key:binary,lead:string,act:string>"
    schema = f"conv {conv}, block long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, edits array<{edit}>, tail string"
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_solved(*(c[i] for c in columns)) for columns in [[c.to_pylist() for c in batch.columns[1:]]] for i in range(batch.num_rows)]
            types = (pa.int64(),) * 6 + (pa.string(), pa.list_(pa.struct([("pos", pa.int64()), ("turn", pa.int64()), ("key", pa.binary()), ("lead", pa.string()), ("act", pa.string())])), pa.string())
            columns = list(zip(*out, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    return stored(whole.mapInArrow(work, schema), "solved")


def _solved(block: int, rows: list[dict], end: list[int], entry: int, before: int, last: bool) -> tuple:
    codes = [r["code"] for r in rows]
    prices = auction(codes, tuple(end))
    exit_, audit, acts, tail = trace(codes, prices, entry, last)
    cost = prices[0][entry] - (0 if last else end[exit_])
    faults = [code % 4 for code in codes]
    initials = [c // 4 for c in ([before] if before >= 0 else []) + codes]
    illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:], strict=False))
    changed = [{"pos": r["pos"], "turn": r["turn"], "key": r["key"], "lead": lead, "act": act} for r, (lead, act) in zip(rows, acts, strict=True)]
    return block, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit, changed, tail


def repaired_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` of the repaired conversations, in order within each partition.

    Rows and edits meet by one exchange and sort: of equal rows any one stands for all,
    each edit then writes it out once more.  Inserted rows have a null turn.
    """
    texts = rows.select("conv", F.lit(0).alias("tail"), "turn", "key", F.lit(0).alias("tag"), F.lit(-1).cast("long").alias("pos"), "role", "text", F.lit("").alias("lead"), F.lit("").alias("act"))
    none = F.lit(None).cast("string")
    one = solved.select("conv", F.explode("edits").alias("e"))
    one = one.select("conv", F.lit(0).alias("tail"), "e.turn", "e.key", F.lit(1).alias("tag"), "e.pos", none.alias("role"), none.alias("text"), "e.lead", "e.act")
    ends = solved.where("tail <> ''").select("conv", F.lit(1).alias("tail"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("key"), F.lit(1).alias("tag"), F.lit(0).cast("long").alias("pos"), none.alias("role"), none.alias("text"), F.col("tail").alias("lead"), F.lit("D").alias("act"))
    order = ["conv", "tail", "turn", "key", "tag", "pos"]
    met = texts.unionByName(one).unionByName(ends).repartition("conv").sortWithinPartitions(*order)
    kind = rows.schema["conv"].dataType.simpleString()
    names = dict(zip(INITIALS, ("system", "user", "assistant"), strict=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        role = text = None
        for batch in batches:
            at, turns, roles, texts = [], [], [], []
            tags, turn, role_, text_, lead, act = (batch.column(i).to_pylist() for i in (1, 2, 3, 4, 5, 6))
            for i, tag in enumerate(tags):
                if tag == 0:
                    role, text = role_[i], text_[i]
                    continue
                new = [(None, names[x], "") for x in lead[i]]
                if act[i] != "D":
                    new.append((turn[i], role if act[i] == "K" else names[act[i]], text))
                for t, r, x in new:
                    at.append(i)
                    turns.append(t)
                    roles.append(r)
                    texts.append(x)
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(turns, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "turn", "role", "text"])

    return met.select("conv", "tag", "turn", "role", "text", "lead", "act").mapInArrow(work, f"conv {kind}, turn long, role string, text string")


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """``conv, sha``: digest of the ``role:text`` lines of every conversation of :func:`repaired_rows`, row after row."""
    kind = repaired.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = held = kind_ = None
        for batch in batches:
            kind_ = batch.schema.field(0).type
            done = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held is None or conv != now:
                    if held is not None:
                        done.append((now, held.hexdigest()))
                    now, held = conv, hashlib.sha256()
                else:
                    held.update(b"\n")
                held.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind_), pa.array([s for _, s in done], pa.string())], ["conv", "sha"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind_), pa.array([held.hexdigest()], pa.string())], ["conv", "sha"])

    return repaired.select("conv", "role", "text").mapInArrow(work, f"conv {kind}, sha string")


def repair_conversations(rows: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """A summary for each conversation of ``rows(conv_id, turn, role, text)``, and the repaired rows.

    The summary is ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha``.
    """
    taken = plain(rows)
    solved = solve(taken, block, fan)
    known = F.count_distinct("turn")
    gaps = taken.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - known, F.lit(0)).cast("long").alias("gaps"))
    sums = [F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], "")
    found = solved.groupBy("conv").agg(*sums, audit.alias("audit"))
    repaired = repaired_rows(taken, solved)
    out = join_null_safe(join_null_safe(gaps, found, ["conv"]), conversation_digests(repaired), ["conv"], "left")
    return out.withColumn("sha", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256))), repaired


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one row in twenty dropped, emptied, stripped of its ends, repeated or given to the user."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    out = rows.where(kind != 0).withColumn("again", F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))))
    return out.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"))


def conversation_report(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """A row for every ``conv_id`` of ``rows``, zeros and empty strings where nothing is left of it."""
    ids: Column = F.col("conv_id").alias("conv")
    all_ = join_null_safe(rows.select(ids).distinct(), summary, ["conv"], "left")
    zero = [F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return all_.select(F.col("conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", nothing).alias("repaired_sha256"))
