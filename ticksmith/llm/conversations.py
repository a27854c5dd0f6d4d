"""Conversation structure repair by secondary-sorted streaming (dealt operator 12).

A conversation should read ``(s?(ua)+)?`` in role initials.  The cheapest edits
that make it so are a shortest path over (row, state of that pattern):

1. ``faults``: each row's fault and role initial, by column expressions; a text
   seen earlier in the conversation is found by a window over digests.
2. ``backward``: rows without their texts, repartitioned by conversation and
   sorted from the last turn to the first, stream through ``mapInPandas``.  The
   state carried across Arrow batches is four costs (cheapest edits from here
   to the end, by pattern state) and a few counters; each row leaves one byte,
   its best edit from each state.  These backpointers leave the task in blocks
   of ``BLOCK`` bytes, so a conversation of any length needs one block of memory,
   and Spark's shuffle stores them where a lost executor's work is redone.
3. ``forward``: whole rows and blocks, repartitioned by conversation and sorted
   from the first turn on, stream through a second ``mapInPandas``, which follows
   the bytes and feeds the repaired rows to a running digest.

The pattern is deterministic and the edits that are open at a state have
different initials, so of equally cheap edits the smallest initial at each step
gives the ASCII-least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16
INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3

# pattern states: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN = [USER, USER, ASSISTANT, USER]                   # where an inserted or reroled turn leads
ROLE = ["user", "user", "assistant", "user"]           # and its role
LEGAL = {"su", "ua", "au"}
# cheapest way from a state to the end of the pattern
END = (0, 2 * INSERT, INSERT, 0)
EDITS = "DIKR"

BLANK, DUPLICATE, CUT = 1, 2, 3     # a row's first fault; 0 is none


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the planted faults of a check sum; ``gone`` marks dropped ones.

    Nulls are one space in the check sum's key and as role or text.  A repeated
    row is two rows.
    """
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    out = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text_of("role").alias("role"),
                      text_of("text").alias("text"), key.alias("lot"))
    return out.select(
        "conv_id", "turn", F.when(F.col("lot") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("lot") == 1, F.lit("")).when(F.col("lot") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("lot") == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("lot") == 3, 2).otherwise(1)))).drop("col")


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``mark``, a digest of role and text that also orders equal turns."""
    pair = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    return rows.withColumn("mark", F.when(~F.col("gone"), F.unhex(F.md5(pair))))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, gone, nth, fault, initial) of marked rows, without their texts."""
    solid = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    ends = F.regexp_like(solid, F.lit(r"[.!?]\z"))
    thin = rows.select("conv_id", "turn", "mark", "gone",
                       F.when(F.length(solid) == 0, BLANK).when(~ends, CUT).otherwise(0).alias("own"),
                       F.substring("role", 1, 1).alias("initial"))
    seen = Window.partitionBy("conv_id", "mark").orderBy(F.col("turn").asc_nulls_first())
    return thin.withColumn("nth", F.row_number().over(seen)).withColumn(
        "fault", F.when(F.col("own") == BLANK, BLANK).when(F.col("nth") > 1, DUPLICATE).otherwise(F.col("own"))).drop("own")


class _Steps:
    """Best edits of a row for every set of costs behind it, kept because few sets occur."""

    def __init__(self):
        self.known: dict = {}

    def __call__(self, after: tuple, fault: int, initial: str):
        """(costs before the row, byte of edits) for the costs after it."""
        low = min(after)
        key = (tuple(c - low for c in after), fault, initial)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = self.best(*key)
        return tuple(c + low for c in found[0]), found[1]

    @staticmethod
    def best(after: tuple, fault: int, initial: str):
        extra, bad = TRUNCATED * (fault == CUT), fault in (BLANK, DUPLICATE)
        cost, edit = [], []
        for q in range(4):
            ways = [(DELETE + after[q], "D")]
            if not bad:
                if (q, initial) in NEXT:
                    ways.append((extra + after[NEXT[q, initial]], "K"))
                ways.append((REROLE + extra + after[TURN[q]], "R"))
            c, e = min(ways)
            cost.append(c)
            edit.append(e)
        for _ in range(2):      # an inserted turn leads to another state of the same row
            for q in range(4):
                if (INSERT + cost[TURN[q]], "I") < (cost[q], edit[q]):
                    cost[q], edit[q] = INSERT + cost[TURN[q]], "I"
        return tuple(cost), sum(EDITS.index(e) << 2 * q for q, e in enumerate(edit))


BLOCKS = "conv string, turn string, mark binary, edits binary, stats array<bigint>"


def _texts(column) -> list:
    """A pandas column as a list with None for nulls."""
    return [None if v is None or v is pd.NA or v != v else v for v in column.tolist()]


def backward(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks (conv, turn, mark, edits, stats) of backpointers, each named by its first row.

    ``edits`` has a byte a row, first row first; equal rows of one turn share
    one, for all but the first are deleted in any case.  The first block of a
    conversation has its counts: gaps, blank, duplicate, truncated, illegal.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, conv, state = _Steps(), object(), None

        def fresh():
            return {"cost": END, "edits": bytearray(), "turn": None, "mark": None, "next": None, "turns": 0,
                    "high": None, "low": None, "count": [0, 0, 0, 0], "illegal": 0, "rows": 0}

        def cut(stats=None):
            return (conv, state["turn"], state["mark"], bytes(reversed(state["edits"])), stats)

        def finish():
            if state is None or not state["rows"]:
                return []
            gaps = 0 if state["high"] is None else state["high"] - state["low"] + 1 - state["turns"]
            return [cut([gaps, *state["count"][1:], state["illegal"]])]

        for batch in batches:
            out = []
            for c, turn, mark, fault, initial in zip(*(_texts(batch[x]) for x in ("conv", "turn", "mark", "fault", "initial")), strict=True):
                if c != conv:
                    out += finish()
                    conv, state = c, fresh()
                state["cost"], edits = step(state["cost"], fault, initial)
                if state["rows"] and (turn, mark) == (state["turn"], state["mark"]):
                    state["edits"][-1] = edits    # of equal rows the first one's byte stays: the others go
                else:
                    if len(state["edits"]) >= block:
                        out.append(cut())
                        state["edits"].clear()
                    state["edits"].append(edits)
                if state["rows"] and initial + state["next"] not in LEGAL:
                    state["illegal"] += 1
                state["next"] = initial
                state["rows"] += 1
                state["count"][fault] += 1
                if turn is not None:
                    at = int(turn)
                    if at != state["low"]:
                        state["turns"] += 1
                    state["high"] = at if state["high"] is None else state["high"]
                    state["low"] = at
                state["turn"], state["mark"] = turn, mark
            if out:
                yield pd.DataFrame(out, columns=["conv", "turn", "mark", "edits", "stats"])
        yield pd.DataFrame(finish(), columns=["conv", "turn", "mark", "edits", "stats"])

    live = rows.where("NOT gone").select(
        F.col("conv_id").cast("string").alias("conv"), "turn", "mark", "nth", "fault", "initial")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").desc_nulls_last(), F.col("mark").desc(), F.col("nth").desc()]
    return (live.repartition("conv").sortWithinPartitions(*order)
            .select("conv", F.col("turn").cast("string").alias("turn"), "mark", "fault", "initial")
            .mapInPandas(run, BLOCKS))


REPAIRED = ("conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
            "audit string, repaired_sha256 string")


def forward(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """A row of ``REPAIRED`` for each conversation of ``rows``, which has the marked rows with their texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = object(), None

        def fresh():
            return {"q": START, "edits": b"", "at": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False,
                    "stats": [0] * 5, "last": None}

        def put(role, text):
            state["hash"].update((("\n" if state["any"] else "") + f"{role}:{text}").encode())
            state["any"] = True

        def insert():
            put(ROLE[state["q"]], "")
            state["audit"].append("I")
            state["cost"] += INSERT
            state["q"] = TURN[state["q"]]

        def finish():
            if state is None:
                return []
            while END[state["q"]]:
                insert()
            return [(conv, *state["stats"], state["cost"], "".join(state["audit"]), state["hash"].hexdigest())]

        for batch in batches:
            out = []
            for c, kind, turn, mark, role, text, edits, stats, fault in zip(
                    *(_texts(batch[x]) if x != "stats" else batch[x].tolist()
                      for x in ("conv", "kind", "turn", "mark", "role", "text", "edits", "stats", "cut")), strict=True):
                if c != conv:
                    out += finish()
                    conv, state = c, fresh()
                if kind == 0:
                    state["edits"], state["at"] = edits, 0
                    if stats is not None:
                        state["stats"] = [int(v) for v in stats]
                elif kind == 1 and (turn, mark) == state["last"]:
                    state["audit"].append("D")
                    state["cost"] += DELETE
                elif kind == 1:
                    state["last"] = (turn, mark)
                    byte = state["edits"][state["at"]]
                    state["at"] += 1
                    while (edit := EDITS[byte >> 2 * state["q"] & 3]) == "I":
                        insert()
                    state["audit"].append(edit)
                    q = state["q"]
                    if edit == "D":
                        state["cost"] += DELETE
                        continue
                    state["cost"] += TRUNCATED * int(fault)
                    if edit == "R":
                        state["cost"] += REROLE
                        put(ROLE[q], text)
                        state["q"] = TURN[q]
                    else:
                        put(role, text)
                        state["q"] = NEXT[q, role[0]]
            if out:
                yield pd.DataFrame(out, columns=NAMES)
        yield pd.DataFrame(finish(), columns=NAMES)

    solid = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    cut = (~F.regexp_like(solid, F.lit(r"[.!?]\z"))).cast("int")
    none = F.lit(None)
    whole = rows.select(F.col("conv_id").cast("string").alias("conv"), F.when(F.col("gone"), 2).otherwise(1).alias("kind"), "turn", "mark",
                        F.when(~F.col("gone"), F.col("role")).alias("role"), F.when(~F.col("gone"), F.col("text")).alias("text"),
                        none.cast("binary").alias("edits"), none.cast("array<bigint>").alias("stats"), F.coalesce(cut, F.lit(0)).alias("cut"))
    named = blocks.select("conv", F.lit(0).alias("kind"), F.col("turn").cast("bigint").alias("turn"), "mark",
                          none.cast("string").alias("role"), none.cast("string").alias("text"), "edits", "stats", F.lit(0).alias("cut"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("mark").asc_nulls_first(), F.col("kind").asc()]
    return (whole.unionByName(named).repartition("conv").sortWithinPartitions(*order)
            .select("conv", "kind", F.col("turn").cast("string").alias("turn"), "mark", "role", "text", "edits", "stats", "cut")
            .mapInPandas(run, REPAIRED))


NAMES = [f.split()[0] for f in REPAIRED.split(", ")]


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` has conv_id, turn, role, text and gone (``damage`` gives such);
    gone rows only name their conversation.  Rows of one turn go by a digest of
    role and text; equal rows stay adjacent.  Null turns go first.  A null conv_id is a
    conversation like any other.  Repeated rows are duplicates.  An empty role has no initial
    that fits.  Texts and conversations of any length stream through; the
    audit, one letter an edit, is the only thing that grows with a conversation.
    Other columns are ignored; an empty table gives an empty result.
    """
    kind = dict(rows.dtypes)["conv_id"]
    whole = marked(rows.select("conv_id", "turn", "role", "text", "gone"))
    found = forward(whole, backward(faults(whole), block))
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *NAMES[1:])
